"""Small inputs for the tests."""

import json

from pyspark.sql import functions as F

from tidemark import schemas

ALL_NOW = {"availableNow": True}


def payload(id, amount=10.0, at="2001-02-03T12:00:00", payment_type="UPI", city="Oslo", **others):
    return json.dumps(
        {
            "transaction_id": id,
            "user_id": "1000",
            "merchant_id": "100",
            "amount": amount,
            "payment_type": payment_type,
            "city": city,
            "transaction_timestamp": at,
            **others,
        }
    )


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "json_data string")


def messages(spark, *values, first=0):
    """Bronze rows of one partition, in the given order."""
    rows = [(v, first + i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "json_data string, offset long").select(
        "json_data",
        F.lit("transactions_raw").alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.timestamp_seconds(F.lit(1_000_000) + F.col("offset")).alias("timestamp"),
    )


def silver_rows(spark, *rows):
    """Rows of (id, amount, payment_type, city, risk_level)."""
    df = spark.createDataFrame(
        list(rows), "transaction_id string, amount double, payment_type string, city string, risk_level string"
    )
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.SILVER.fields
        ]
    )


def history(spark, dimension, *rows):
    """Rows of (value, count, total, time)."""
    df = spark.createDataFrame(
        [(v, n, float(t), at) for v, n, t, at in rows],
        f"{dimension} string, transaction_count long, total_amount double, at string",
    )
    return df.select(
        dimension,
        "transaction_count",
        "total_amount",
        (F.col("total_amount") / F.col("transaction_count")).alias("avg_amount"),
        F.col("at").cast("timestamp").alias("snapshot_time"),
    )


def rows(df, *columns):
    found = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(found, key=repr)
