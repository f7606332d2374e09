"""Operator 2, secret scans: corpus-wide ownership frequency.

Candidates are found text by text; their values' hashes are then counted over
the whole corpus by distinct repositories and owners.  Values that many owners or
repositories have are copied examples; a value that one owner has in few looks live.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, skew_join, stage

# The base patterns, with the least length of the part that counts.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")       # runs are whole, so the least length may stand in the pattern
HEX = re.compile(r"[0-9a-f]{16,}")
#: Candidates of the method: long mixed tokens, with at least so many bits a character.
MIXED = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MIN_BITS = 3.5


def bits_per_char(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) in that order, of the base patterns and
    of mixed tokens that no base span overlaps."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    base = sorted(found)
    for m in MIXED.finditer(text):
        value = m[0]
        if (re.search("[0-9]", value) and re.search("[A-Z]", value) and re.search("[a-z]", value)
                and bits_per_char(value) >= MIN_BITS
                and not any(s < m.end() and m.start() < e for s, _, e, _ in base)):
            found.append((m.start(), 3, m.end(), value))
    return sorted(found)


def scan_secrets(docs: DataFrame, example_owners: int = 3, example_repos: int = 8, live_repos: int = 2, id_col: str = "doc_id", text_col: str = "text",
                 owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row per row of ``docs``: ``id_col`` and secrets, an array of (start,
    end, kind, n_owners, n_repos, verdict) by start and kind; offsets are code
    points, end exclusive, of the whole match.

    Every base span is in it (assign, access, hex).  A mixed token (20 or more
    characters of the base64 alphabets with a digit, a capital and a small
    letter, 3.5 or more bits a character, clear of base spans) is added as
    ``owned`` when its value is live.  verdict, of a span's value, by both counts:

    * ``live``: one owner has it, in at most ``live_repos`` repositories;
    * ``example``: ``example_owners`` or more have it, or ``example_repos`` or
      more repositories, be they one owner's: it is copied around;
    * ``shared``: all between.

    Owners and repositories are distinct values of ``owner_col`` and
    ``repo_cols``; null is one value.

    Null texts are empty: no secrets.  Repeated rows each get their row, and
    count as one repository.  Texts may be of any length (patterns are linear in
    it).  An empty table gives an empty result; other columns, whatever their names,
    aren't read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
                       F.to_json(F.struct(F.col(owner_col).alias("o"))).alias("owner"),
                       F.to_json(F.struct(*[F.col(c).alias(f"r{i}") for i, c in enumerate(repo_cols)])).alias("repo"),
                       F.col(text_col).alias("text"))

    def scan(batch):
        found = [candidates(t or "") for t in batch["text"].to_pylist()]
        return {c: batch[c] for c in ("uid", "id", "owner", "repo")} | {
            "hits": [[{"start": s, "kind": k, "end": e, "hash": xxhash.xxh3_128_hexdigest(v.encode("utf-8", "surrogatepass"))}
                      for s, k, e, v in hits] for hits in found]}

    id_type = docs.schema[id_col].dataType.simpleString()
    scanned = stage(map_arrow(rows, scan, f"uid long, id {id_type}, owner string, repo string, "
                                          "hits array<struct<start: long, kind: int, end: long, hash: string>>"))
    hits = stage(scanned.where("size(hits) > 0").select("uid", "owner", "repo", F.explode("hits").alias("hit"))
                 .select("uid", "owner", "repo", "hit.*"))
    # A value's rows shrink to its repositories, then to its owners, in the map tasks first.
    usage = (hits.groupBy("hash", "owner", "repo").agg(F.count("*").alias("_rows"))
             .groupBy("hash", "owner").agg(F.sum("_rows").alias("_rows"), F.count("*").alias("_repos"))
             .groupBy("hash").agg(F.sum("_rows").alias("_rows"), F.sum("_repos").alias("n_repos"),
                                  F.count("*").alias("n_owners")))
    copied = (F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos)
    verdict = (F.when(copied, "example")
               .when((F.col("n_owners") == 1) & (F.col("n_repos") <= live_repos), "live").otherwise("shared"))
    known = skew_join(hits.drop("owner", "repo"), stage(usage), "hash", "_rows").withColumn("verdict", verdict)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    per_doc = (known.where("kind < 3 or verdict = 'live'")
               .groupBy("uid")
               .agg(F.sort_array(F.collect_list(F.struct("start", F.col("kind").alias("nr"), "end", kind.alias("kind"),
                                                         "n_owners", "n_repos", "verdict"))).alias("secrets")))
    empty = F.array().cast(per_doc.schema["secrets"].dataType)
    return (scanned.drop("hits", "owner", "repo").join(per_doc, "uid", "left")
            .select(F.col("id").alias(id_col), F.coalesce("secrets", empty).alias("secrets")))


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(field, value):
        return F.size(F.filter("secrets", lambda s: s[field] == value)).cast("long")

    base = F.filter("secrets", lambda s: s["nr"] < 3)
    return found.select(
        "doc_id", *[count("kind", k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"),
        # of each span, in the order of spans: owners:repositories of its value
        F.array_join(F.transform("secrets", lambda s: F.concat_ws(":", s["n_owners"].cast("string"), s["n_repos"].cast("string"))), ",").alias("owners_repos"),
        *[count("verdict", v).alias(f"n_{v}") for v in ("live", "shared", "example")])
