"""Raw quote messages, and quotes derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickframe.schemas import EVENTS


def read_raw(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = False,
    format: str = "text",
    arrival: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Raw quote text in ``value``, one JSON message per line or row.

    Rows of other formats than text may also have a column that recorded their ``arrival``.
    """
    schema = "value string" + (f", `{arrival}` timestamp_ntz" if arrival else "")
    if arrival and format == "text":
        raise ValueError("text files have no arrival column")
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.schema(schema).format(format).load(path)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A declared schema spares the job that reads footers to infer one.
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _price_text(price: Column) -> Column:
    return F.format_string("%.8f", price)


def clean_ticks(event_rows: DataFrame) -> DataFrame:
    """Every event as a typed tick: pair = event type, bid = value, ask half a unit above."""
    return event_rows.select(
        F.col("event_id").alias("sequence"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("pair"),
        F.col("value").cast("decimal(20,8)").alias("bid"),
        (F.col("value") + 0.5).cast("decimal(20,8)").alias("ask"),
    )


def raw_quotes(event_rows: DataFrame) -> DataFrame:
    """Every event as raw quote text; in each 50 events five have faulty bids."""
    slot = F.col("event_id") % 50
    bid = (
        F.when(slot == 0, F.lit(None))
        .when(slot == 1, "abc")
        .when(slot == 2, "nan")
        .when(slot == 3, "")
        .when(slot == 4, "99999999999.5")
        .otherwise(_price_text(F.col("value")))
    )
    quote = F.struct(
        F.col("event_id").alias("u"),
        F.concat(F.upper("event_type"), F.lit("USDT")).alias("s"),
        bid.alias("b"),
        _price_text(F.col("value") + 0.5).alias("a"),
    )
    return event_rows.select(F.to_json(quote).alias("value"), F.col("ts").alias("arrived"))


def null_time_ticks(event_rows: DataFrame) -> DataFrame:
    """Every event as a text-priced tick; in 50 events one lacks its time, one has a huge bid."""
    slot = F.col("event_id") % 50
    return event_rows.select(
        F.col("event_id").alias("sequence"),
        F.col("event_type").alias("pair"),
        F.when(slot == 4, "99999999999.5").otherwise(_price_text(F.col("value"))).alias("bid"),
        _price_text(F.col("value") + 0.5).alias("ask"),
        F.when(slot != 5, F.col("ts")).alias("timestamp"),
    )
