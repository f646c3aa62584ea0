"""What a micro-batch counts in passing: no job is run for it."""

import json
import logging

from helpers import ALL_NOW, messages, payload, silver_rows

from tidemark import fixtures, journal, schemas, streaming
from tidemark.streaming.progress import summarise


def test_gold_reports_silver_rows_and_changed_values(spark, paths, capsys):
    rows = [(str(i), 10.0, "UPI", f"c{i % 3}", "LOW") for i in range(7)]
    fixtures.deliver(silver_rows(spark, *rows), paths.silver)
    query = streaming.gold_stream(spark, paths, trigger=ALL_NOW, preview=5)
    query.awaitTermination()
    line = summarise(json.loads(query.lastProgress.json))
    assert line["observed"] == {"silver": {"rows": 7}, "changed": {"rows": 5}} and line["state_rows"] == 5
    assert "transaction_count" in capsys.readouterr().out


def test_the_ledger_reports_new_entries_and_alerts(spark, paths, caplog):
    caplog.set_level(logging.INFO, "tidemark.streaming")
    deliveries = ([payload("a", 4600.0), payload("b", 1.0), payload("a", 2.0)], [payload("b", 3.0), payload("c", 4.0)])
    for i, values in enumerate(deliveries):
        fixtures.write_bronze(messages(spark, *values, first=10 * i), paths.bronze)
        stream = journal.rows(journal.entries(spark, paths.bronze, "ledger"), schemas.BRONZE)
        streaming.ledger_stream(stream, paths, ALL_NOW).awaitTermination()
    lines = [r.getMessage() for r in caplog.records if "ledger batch" in r.getMessage()]
    assert lines == ["ledger batch 0: 2 entries, 1 alerts", "ledger batch 1: 1 entries, 0 alerts"]
