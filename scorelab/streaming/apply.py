"""Stream-safe apply operators.

The reference has no streams. What keeps streaming possible is that every
*apply* step (clean, engineer, scale, winsorise, encode PAY, calibrate) is
a projection or a join against a small static parameter table, so the same
functions run unchanged on ``spark.readStream`` DataFrames. Fits stay batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calibrate import apply_platt
from ..operators.clean import clean_categoricals
from ..operators.features import engineer_features


def read_accounts_stream(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    """Parquet files arriving in ``path`` as a stream (explicit schema)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def prepare_stream(stream: DataFrame) -> DataFrame:
    """Clean + engineer: pure projections, valid on a streaming DataFrame."""
    return engineer_features(clean_categoricals(stream))


def calibrate_stream(stream: DataFrame, platt_params: DataFrame, by: list[str] = ("run",)) -> DataFrame:
    """Apply fitted Platt parameters (a static table) to streaming score rows."""
    return apply_platt(stream, platt_params, list(by))


def run_to_table(stream: DataFrame, name: str, checkpoint: str) -> None:
    """Drain all available input into a memory table (tests and smoke runs)."""
    q = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", checkpoint).outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def windowed_rates(stream: DataFrame, ts: str, target: str, window: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """Target rate per event-time window with a watermark for late rows."""
    return stream.withWatermark(ts, watermark).groupBy(F.window(ts, window)).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(target).cast("double")).alias("rate"))
