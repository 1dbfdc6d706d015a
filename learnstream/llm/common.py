"""Helpers shared by the operators: tables, scratch tables, Arrow streams."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from learnstream.session import ensure_checkpoint_dir

# Bounds of one Arrow batch between the JVM and a Python worker.
BATCH_ROWS = 2000
BATCH_BYTES = 32 << 20
GROUP_CHARS = 4 << 20        # texts are worked on in groups of about this size


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_names(columns: list[str], *names: str) -> list[str]:
    """The names, made longer until they are none of ``columns`` in any case of letters."""
    held = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that very long texts fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/learnstream-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps start
    from the files, whatever executor is lost. Parquet, so columns prune."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, df: DataFrame | None = None) -> None:
    """Delete the files of one ``materialize`` result that nothing reads any
    more, or (without ``df``) all scratch files of this application. Call the
    latter when the results built on them have been written."""
    paths = [scratch_root(spark)] if df is None else list({f.rpartition("/")[0] for f in df.inputFiles()})
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]):
    """``mapInArrow`` function that maps each record batch on its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if out is not None and out.num_rows:
                    yield out
    return run


def text_groups(texts: list[str], chars: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) of about ``chars`` characters each."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= chars or k == len(texts) - 1:
            yield at, texts[at:k + 1]
            at, size = k + 1, 0


def running_total(df: DataFrame, order: list[Column], weight: str, name: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``weight`` over the rows that come
    earlier in the total order. A range sort, sums in each of its tasks, and
    one row a task to add up; the result is written to the shared folder."""
    kinds = StructType([*df.schema.fields]).add("_before", LongType()).add("_task", LongType())

    def run(batches):
        from pyspark import TaskContext
        task, total = TaskContext.get().partitionId(), 0
        for b in batches:
            w = b.column(weight).to_numpy()
            ends = w.cumsum() + total
            total = int(ends[-1]) if len(ends) else total
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(ends - w, pa.int64()), pa.array([task] * len(w), pa.int64())], kinds.names)

    own = materialize(df.sort(*order).mapInArrow(run, kinds), name)
    tasks = own.groupBy("_task").agg(F.sum(weight).alias("_sum"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    base = tasks.select("_task", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    # as many rows as the sort has tasks
    return (own.join(F.broadcast(base), "_task")
            .withColumn("before", F.col("_before") + F.col("_base")).drop("_task", "_before", "_base"))
