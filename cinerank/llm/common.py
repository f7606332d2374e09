"""Helpers shared by the corpus operators.

Words are everywhere the runs of ``[^\\x20\\x09-\\x0D]+``; on UTF-8 bytes that
is exactly ``bytes.split()``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType

from ..functions.ranking import reliable_checkpoint
from ..session import ship_package

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER_TABLE = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())

#: A key counts as hot when it holds over 1/HOT_KEYS of the rows, so at most
#: HOT_KEYS keys are ever hot: the size bound of ``skew_join``'s broadcast.
HOT_KEYS = 1000
#: Tasks a core, and narrow rows of a task, up to which ``few_tasks`` makes more tasks.
TASKS_A_CORE, TASK_ROWS = 4, 100_000


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read
    it back: cuts the lineage, and survives lost executors."""
    return reliable_checkpoint(df)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def ascii_lower_bytes(data: bytes) -> bytes:
    return data.translate(_LOWER_TABLE)


def split_words(text: str | None) -> list[bytes]:
    """UTF-8 words of a text; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def joined_words(text: str | None, lower: bool = False) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by one space, with each word's first byte and end."""
    words = split_words(text)
    joined = b" ".join(words)
    if lower:
        joined = ascii_lower_bytes(joined)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1]) if len(words) else ends
    return joined, starts, ends


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str | StructType, max_rows: int | None = None) -> DataFrame:
    """``mapInArrow`` where ``fn`` turns one record batch into columns (a dict
    of sequences, in the order of ``schema``); batches stay small (``max_rows``, where
    a row becomes many), so memory is bounded by one batch of texts, never by a
    partition."""
    ship_package(df.sparkSession)
    target = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, max_rows=max_rows):
                out = fn(part)
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def shielded(docs: DataFrame, *apart: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns, but those of ``apart``, under names that can't clash
    with an operator's own, and these names by column."""
    names = {c: c if c in apart else f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def restored(names: dict[str, str], skip: tuple[str, ...] = ()) -> list[Column]:
    """The caller's columns of a shielded table, under their names."""
    return [F.col(n).alias(c) for c, n in names.items() if c not in skip]


def row_key(id_col: Column, text: Column, nulls: int) -> tuple[Column, Column]:
    """(doc, row), two longs that stand for a row's id (``nulls`` for a null one)
    and text: the join key of results with the table they were made from."""
    return F.coalesce(id_col.cast("long"), F.lit(nulls).cast("long")).alias("_doc"), F.xxhash64(text, text.isNull()).alias("_row")


def pack_text(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with its text packed by zstd (null stays null), to be shuffled at
    about a third of its size."""
    def pack(batch):
        press = zstandard.ZstdCompressor(level=3)
        return {c: batch[c] for c in batch.schema.names} | {text_col: [
            None if t is None else press.compress(t.encode("utf-8", "surrogatepass")) for t in batch[text_col].to_pylist()]}

    return map_arrow(df, pack, StructType([StructField(f.name, BinaryType() if f.name == text_col else f.dataType) for f in df.schema]))


def unpack_text(data: bytes | None) -> str | None:
    return None if data is None else zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass")


def text_slices(batch: pa.RecordBatch, max_bytes: int = 8 << 20, max_rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut a batch in runs of rows of about ``max_bytes`` (a longer row alone),
    so that a batch of very long texts isn't worked on all at once."""
    row = max(1, batch.nbytes // max(1, batch.num_rows))
    step = min(max(1, max_bytes // row), max_rows or batch.num_rows or 1)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def skew_join(rows: DataFrame, table: DataFrame, key: str, n_rows: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row a key and in
    ``n_rows`` how many of ``rows`` have that key.

    Keys with over 1/HOT_KEYS of all rows (at most HOT_KEYS of them, which the driver
    lists) are joined by broadcast, without moving ``rows``; the others by a shuffle
    join, where no key is large.  Both inputs are read twice: give staged tables.
    """
    total, most = table.agg(F.sum(n_rows), F.max(n_rows)).first()
    limit = max(1, (total or 0) // HOT_KEYS)
    if (most or 0) <= limit:
        return rows.join(table, key)
    hot = table.where(F.col(n_rows) > limit)
    keys = [r[0] for r in hot.select(key).collect()]
    return (rows.join(F.broadcast(hot), key)
            .unionByName(rows.where(~F.col(key).isin(keys)).join(table.where(F.col(n_rows) <= limit), key)))


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` narrow rows, in no more tasks than are worth their start: a
    small table isn't written by one task a shuffle partition."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(TASKS_A_CORE * cores, -(-rows // TASK_ROWS)))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns): the
    component's smallest node.  Large-star and small-star rounds; each keeps
    the graph's components and ends in stars around the smallest nodes after
    about log(n) rounds.  A node's smallest neighbour is a partial aggregate; it is
    joined back from a staged table, so that adaptive execution can split the
    rows of a hub, which are never gathered.
    """
    cur = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    while True:
        n = 2 * cur.count()
        both = cur.union(cur.select("v", "u")).toDF("u", "v")
        low = stage(few_tasks(both.groupBy("u").agg(F.min("v").alias("m"), F.count_if(F.col("v") < F.col("u")).alias("below"), F.count("*").alias("n")), n))
        # Stars around the smallest nodes: a node has one neighbour below it and no other, or none below.
        if low.where("below > 0 and n > 1").isEmpty():
            break
        low = low.select("u", F.least("u", "m").alias("m"))
        # Large star: neighbours above a node hang on the node's smallest neighbour.
        large = few_tasks(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), n)
        large = stage(few_tasks(large.distinct(), n))
        # Small star: neighbours below a node, and itself, hang on the smallest of them.
        low = stage(few_tasks(large.groupBy("u").agg(F.min("v").alias("m")), n))
        below = few_tasks(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), n)
        cur = stage(few_tasks(below.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), n))
    stars = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(cur.select(F.col("v"), F.col("v")).distinct())
