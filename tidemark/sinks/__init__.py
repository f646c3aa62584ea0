from tidemark.sinks.files import append_batch, create_table, write_batch
from tidemark.sinks.jdbc import jdbc_append

__all__ = ["append_batch", "create_table", "jdbc_append", "write_batch"]
