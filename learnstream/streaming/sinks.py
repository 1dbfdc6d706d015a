"""Hand a batch's changed rows to an external table, repeatably.

A job calls its sink with (changed rows, batch id) after they are in its state. A batch that
fails after the write is run again with the same id and the same rows:

* ``partition_writer`` overwrites the partition of its batch id and no other, so every
  batch's rows stand once;
* ``staging_writer`` appends through any Spark writer, ``jdbc`` included, and cannot take
  rows back: a reader takes the last row of a key by batch id (``latest``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Sink = Callable[[DataFrame, int], None]


def _of_batch(df: DataFrame, batch_id: int) -> DataFrame:
    return df.withColumn("batch_id", F.lit(batch_id).cast("long"))


def partition_writer(path: str, fmt: str = "parquet", **options: str) -> Sink:
    def write(df: DataFrame, batch_id: int) -> None:
        (_of_batch(df, batch_id).write.format(fmt).options(**options).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").save(path))
    return write


def staging_writer(fmt: str, **options: str) -> Sink:
    def write(df: DataFrame, batch_id: int) -> None:
        _of_batch(df, batch_id).write.format(fmt).options(**options).mode("append").save()
    return write


def latest(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of every key the row of its last batch; equal however often a batch was run."""
    rest = [c for c in staged.columns if c not in (*keys, "batch_id")]
    row = F.max_by(F.struct(*rest), "batch_id").alias("r")
    return staged.groupBy(*keys).agg(row).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])
