"""A current table of ratings that loads are merged into, bucket by bucket.

Keys are hashed into buckets; each bucket is one Parquet folder and a manifest
names the folder of each.  A load is compared with the buckets its keys fall in,
rows that are newer than what is there are kept, and only buckets with such rows are
written again (copy on write).  The manifest of the next version is published
last: readers see a load as a whole or not, and of two writers one has to try again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import reliable_checkpoint
from ..operators.quality import dedup_latest
from . import commit


class ConcurrentMerge(RuntimeError):
    """Another load was merged meanwhile: nothing was changed, merge again."""


class KeyedTable:
    """The latest row a key by ``order_cols`` (a total order), in ``buckets``."""

    def __init__(self, spark: SparkSession, path: str, keys=("user_id", "movie_id"), order_cols=("timestamp",), buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.order_cols, self.buckets = list(keys), list(order_cols), buckets

    def manifest(self) -> dict:
        """The last version: its number, folder by bucket, and merged load ids."""
        versions = commit.names(self.spark, f"{self.path}/manifest")
        return commit.load(self.spark, f"{self.path}/manifest/{versions[-1]}") if versions else \
            {"version": 0, "folders": {}, "loads": [], "schema": None, "buckets": self.buckets}

    def _rows(self, state: dict, only: list[int] | None = None) -> DataFrame | None:
        folders = [f for b, f in state["folders"].items() if only is None or int(b) in only]
        return self.spark.read.schema(state["schema"]).parquet(*[f"{self.path}/{f}" for f in sorted(folders)]) if folders else None

    def read(self) -> DataFrame:
        """The current rows (an error before the first load)."""
        state = self.manifest()
        if state["schema"] is None:
            raise FileNotFoundError(f"no load was merged into {self.path}")
        rows = self._rows(state)
        return self.spark.createDataFrame([], state["schema"]) if rows is None else rows

    def merge(self, load_id: str, rows: DataFrame) -> bool:
        """Merge a load; False if that changes nothing (it was merged before, or
        has no row newer than the table's).  Null order values come before all."""
        state = self.manifest()
        if load_id in state["loads"]:
            return False
        of = F.pmod(F.xxhash64(*self.keys), F.lit(state["buckets"])).cast("int")
        # Nulls order below every value in Spark's struct order, as in max_by.
        new = reliable_checkpoint(dedup_latest(rows, self.order_cols, tuple(self.keys)).select(rows.columns).withColumn("_bucket", of))
        touched = sorted(r[0] for r in new.select("_bucket").distinct().collect())          # at most `buckets` numbers
        old = self._rows(state, touched)
        if old is None:
            effective = new
        else:
            order = F.struct(*self.order_cols)
            there = old.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], order.alias("_old"))
            same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)]
            kept = new.join(there, same, "left").where(F.col("_old").isNull() | (order > F.col("_old")))
            effective = reliable_checkpoint(kept.select(new.columns))
        changed = sorted(r[0] for r in effective.select("_bucket").distinct().collect())
        version = state["version"] + 1
        folders = dict(state["folders"])
        if changed:
            before = self._rows(state, changed)
            after = effective if before is None else dedup_latest(
                effective.unionByName(before.withColumn("_bucket", of)), self.order_cols, tuple(self.keys))
            name = f"data/{version:010d}-{uuid.uuid4().hex}"
            # the bucket's rows in one task each: a bucket is the unit that is written again
            after.select(new.columns).repartition(len(changed), "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{name}")
            folders |= {str(b): f"{name}/_bucket={b}" for b in changed}
        schema = state["schema"] or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        if not commit.publish(self.spark, f"{self.path}/manifest/{version:010d}.json", {
                "version": version, "folders": folders, "loads": [*state["loads"], load_id], "schema": schema, "buckets": state["buckets"]}):
            raise ConcurrentMerge(f"version {version} of {self.path} was published by another writer")
        return bool(changed)
