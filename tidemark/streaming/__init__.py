from tidemark.streaming.bronze import bronze_stream
from tidemark.streaming.gold import gold_stream
from tidemark.streaming.ledger import ledger_stream
from tidemark.streaming.progress import ProgressLog
from tidemark.streaming.silver import rejects_stream, silver_stream

__all__ = ["ProgressLog", "bronze_stream", "gold_stream", "ledger_stream", "rejects_stream", "silver_stream"]
