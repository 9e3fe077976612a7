"""Trip records as JSON messages: encoding, decoding and the message-bus source and sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions.derive import nan_to_null
from roadlens.schema import STREAM_SCHEMA


def read_messages(
    spark: SparkSession, servers: str, topic: str = "trips", **options: str
) -> DataFrame:
    """Streaming subscription from the earliest offset, tolerating expired data."""
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **options,
    }
    return spark.readStream.format("kafka").options(**settings).load()


def write_messages(df: DataFrame, servers: str, topic: str = "trips") -> None:
    """Publishes encoded records (a ``value`` column)."""
    df.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()


def encode(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON text per record in ``value``; times in ISO form, missing fields left out."""
    fields = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def decode(df: DataFrame, schema: T.StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns of the JSON text in ``value``.

    A malformed record gives NULL in every column, a field of the wrong type NULL in its own;
    NaN becomes NULL. The record is unpacked by a generator, which no later filter can be moved
    below: otherwise every filter on a field would parse the text once more.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return nan_to_null(df.select(*keep, F.inline(F.array(parsed))))


def decode_trips(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return decode(df, STREAM_SCHEMA, keep)
