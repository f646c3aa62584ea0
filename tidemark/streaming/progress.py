"""Progress of streaming queries, without extra jobs for counting or printing."""

from __future__ import annotations

import json
import logging

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("tidemark.streaming")


class ProgressLog(StreamingQueryListener):
    """Logs one line per micro-batch: rows read, duration, rows of state, and what the query counted in passing."""

    def onQueryStarted(self, event) -> None:
        log.info("%s started", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        log.info("%s", json.dumps(summarise(json.loads(event.progress.json))))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            log.error("%s failed: %s", event.id, event.exception)
        else:
            log.info("%s stopped", event.id)


def summarise(progress: dict) -> dict:
    observed = progress.get("observedMetrics")
    return {
        "query": progress.get("name") or progress.get("id"),
        "batch": progress.get("batchId"),
        "rows": progress.get("numInputRows"),
        "milliseconds": progress.get("durationMs", {}).get("triggerExecution"),
        "state_rows": sum(op.get("numRowsTotal", 0) for op in progress.get("stateOperators", [])),
        **({"observed": observed} if observed else {}),
    }
