"""tidemark: payment analytics as Spark DataFrame operators, in batch and in streaming."""

__version__ = "0.1.0"
