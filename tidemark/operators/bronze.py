"""Raw messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas


def to_bronze(messages: DataFrame) -> DataFrame:
    """The message text, and where the message stood in the stream if the source tells.

    The position is what makes "first write wins" well defined later on.
    """
    position = [name for name in schemas.ARRIVAL.fieldNames() if name in messages.columns]
    return messages.select(F.col("value").cast("string").alias("json_data"), *position)
