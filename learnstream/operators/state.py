"""Keyed result state and its per-batch merge M.

The reference keeps results in MySQL rows updated one key at a time. Here a
result table is a DataFrame; a batch is merged into it with one full-outer
join on the key. Streaming jobs write what a batch changed under its batch id
(``ChangeLog``) in the shared checkpoint folder, so a batch that is run again
rewrites the same rows: accumulation is idempotent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def merge(old: DataFrame, new: DataFrame, keys: Sequence[str], *,
          replace: Sequence[str] = (), accumulate: Sequence[str] = (),
          keep_first: Sequence[str] = ()) -> DataFrame:
    """Merge M. ``replace``: the new value wins on a key hit (S7, S12);
    ``accumulate``: old + new (S8); ``keep_first``: the stored value stays,
    the new one only fills a new key (S9). Keys missing from ``new`` keep
    their row."""
    cols = [*replace, *accumulate, *keep_first]
    o = old.select(*[F.col(k).alias(f"_ok_{k}") for k in keys],
                   *[F.col(c).alias(f"_o_{c}") for c in cols])
    n = new.select(*[F.col(k).alias(f"_nk_{k}") for k in keys],
                   *[F.col(c).alias(f"_n_{c}") for c in cols])
    cond = None
    for k in keys:  # null-safe: a null key value is a key like any other
        c = F.col(f"_ok_{k}").eqNullSafe(F.col(f"_nk_{k}"))
        cond = c if cond is None else cond & c
    j = o.join(n, cond, "full_outer").select(
        *[F.coalesce(F.col(f"_ok_{k}"), F.col(f"_nk_{k}")).alias(k) for k in keys],
        *[F.col(f"_o_{c}") for c in cols], *[F.col(f"_n_{c}") for c in cols])
    out = [F.coalesce(F.col(f"_n_{c}"), F.col(f"_o_{c}")).alias(c) for c in replace]
    out += [(F.coalesce(F.col(f"_o_{c}"), F.lit(0)) + F.coalesce(F.col(f"_n_{c}"), F.lit(0)))
            .alias(c) for c in accumulate]
    out += [F.coalesce(F.col(f"_o_{c}"), F.col(f"_n_{c}")).alias(c) for c in keep_first]
    return j.select(*keys, *out)


def update_existing(old: DataFrame, new: DataFrame, keys: Sequence[str],
                    cols: Sequence[str]) -> DataFrame:
    """Set ``cols`` from ``new`` only on keys already stored."""
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in cols])
    j = old.join(n, list(keys), "left")
    rest = [c for c in old.columns if c not in keys and c not in cols]
    return j.select(*keys, *rest, *[F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) for c in cols])


def progress(records: DataFrame, group: str) -> DataFrame:
    """Next position to read per (group, topic, partition)."""
    return (records.groupBy("topic", "partition")
            .agg((F.max("offset") + 1).cast("long").alias("until_offset"))
            .select(F.lit(group).alias("grp"), "topic", "partition", "until_offset"))


class ChangeLog:
    """Keyed rows written per batch id, and their current values.

    Batch n writes ``<path>/b=n`` only: the keys it changed. With ``add`` the
    values of a key are summed over batches, else the last batch's row wins.
    Every ``every`` batches the rows so far are written as one ``base=n``, and
    what is older than the base before it goes, so the folders stay bounded
    and a batch that is run again after a failure still finds the state it
    had. A missing predecessor is an error, never an empty state."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str],
                 add: Sequence[str] = (), every: int = 20):
        self.spark, self.path, self.keys, self.add, self.every = spark, path.rstrip("/"), list(keys), list(add), every

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def held(self, kind: str) -> list[int]:
        """Batch ids that are completely written as ``b`` or as ``base``."""
        p, fs = self._fs()
        names = [st.getPath() for st in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.getName().partition("=")[2]) for n in names
                      if n.getName().startswith(f"{kind}=") and fs.exists(n.suffix("/_SUCCESS")))

    def read(self, before: int | None = None, keys: DataFrame | None = None) -> DataFrame | None:
        """Current row per key (of ``keys`` only, if given) after all batches,
        or after those before a batch id; None if there are none."""
        ok = lambda n: before is None or n < before
        base = max(filter(ok, self.held("base")), default=-1)
        batches = [n for n in self.held("b") if n > base and ok(n)]
        last = batches[-1] if batches else base
        if batches != list(range(base + 1, last + 1)) or (before is not None and last != before - 1):
            raise RuntimeError(f"{self.path}: batches are missing before {before}, found {base} and {batches}")
        parts = [f"base={base}"] * (base >= 0) + [f"b={n}" for n in batches]
        out = None
        for order, part in enumerate(parts):
            df = self.spark.read.parquet(f"{self.path}/{part}")
            df = df if keys is None else df.join(keys, self.keys, "left_semi")
            df = df.withColumn("_order", F.lit(order))
            out = df if out is None else out.unionByName(df)
        if out is None:
            return None
        rest = [c for c in out.columns if c not in (*self.keys, "_order")]
        if self.add:
            return out.groupBy(*self.keys).agg(*[F.sum(c).cast("long").alias(c) for c in self.add])
        row = F.max_by(F.struct(*rest), "_order").alias("r")
        return out.groupBy(*self.keys).agg(row).select(*self.keys, *[F.col(f"r.{c}").alias(c) for c in rest])

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/b={batch_id}")
        if (batch_id + 1) % self.every == 0:
            bases = [n for n in self.held("base") if n < batch_id]
            self.read(before=batch_id + 1).write.mode("overwrite").parquet(f"{self.path}/base={batch_id}")
            _, fs = self._fs()
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
            keep = bases[-1] if bases else -1
            for old in [f"base={n}" for n in bases[:-1]] + [f"b={n}" for n in self.held("b") if n <= keep]:
                fs.delete(path(f"{self.path}/{old}"), True)
