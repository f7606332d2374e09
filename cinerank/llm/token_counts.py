"""Operator 10, token counts: offset-mapped attribution.

A document's fields are joined to one text, encoded once as a whole; the
tokens' spans are then joined with the spans of fields and of the last
field's sections, and a token that crosses a boundary goes where a rule says.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .tokenizing import byte_encoder, tokenizer_path

RULES = ("majority", "first", "last")


def join_spans(ends: np.ndarray, spans: np.ndarray, rule: str = "majority") -> tuple[np.ndarray, np.ndarray]:
    """Interval join of tokens (their end offsets; each starts where the one
    before ends) with ``spans`` (sorted, disjoint [start, end) rows): the span
    of each token, and whether the token reaches over a span's boundary.

    A token within a span is that span's.  One that meets several goes to the
    span with most of it, the earlier at a tie (``majority``), to the first, or to
    the last of them.  One that meets none (only separators) belongs to the span
    before it, or to the first span.
    """
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]]) if len(ends) else ends
    solid = np.flatnonzero(spans[:, 1] > spans[:, 0])          # empty spans meet no token
    if not len(solid):
        return np.zeros(len(ends), np.int64), np.zeros(len(ends), bool)
    left, right = spans[solid, 0], spans[solid, 1]
    low = np.searchsorted(right, starts, side="right")          # first span that ends after the token's start
    high = np.searchsorted(left, ends, side="left") - 1         # last span that starts before its end
    none = low > high
    own = np.where(none, high, low if rule != "last" else high).clip(0, len(solid) - 1)
    several = np.flatnonzero(high > low)
    if rule == "majority":
        for k in several:                                        # a token meets few spans
            near = slice(low[k], high[k] + 1)
            own[k] = low[k] + int(np.argmax(np.minimum(right[near], ends[k]) - np.maximum(left[near], starts[k])))
    crosses = ~none & ((starts < left[own]) | (ends > right[own]))
    return solid[own], crosses


def token_counts(docs: DataFrame, fields: tuple[str, ...] = ("lang", "source", "text"), separator: str = "\n",
                 section: str | None = r"\n", rule: str = "majority", path: str | None = None,
                 id_col: str = "doc_id") -> DataFrame:
    """Tokens by field and section: ``id_col``, field, section (0-based), start
    and end (code points in the field), n_tokens, n_crossing (those of them that
    also cover characters outside the section), doc_tokens.

    The fields, null as empty, are joined by ``separator``; the last one is cut
    in sections at the matches of ``section`` (None: one section).  Tokens are
    byte-level, so their byte lengths are their offsets; a character that several
    tokens spell counts by its bytes.  A document's n_tokens add up to its
    doc_tokens.  Empty fields and sections have a row with 0 tokens; a document of
    empty fields has its separators' tokens in the first field.  Every row of
    ``docs`` gets its rows, repeated ones too; an empty table gives none.
    """
    if rule not in RULES:
        raise ValueError(f"rule: one of {RULES}")
    path = path or tokenizer_path("byte_bpe_50k.tiktoken")
    cut = re.compile(section) if section else None
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"f{i}") for i, f in enumerate(fields)])
    gap = len(separator.encode())

    def count(batch):
        encoder = byte_encoder(path)
        parts = {k: [] for k in ("id", "field", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens")}
        for doc, *values in zip(*(batch[c].to_pylist() for c in batch.schema.names)):
            spans, names, chars, at = [], [], [], 0
            for i, value in enumerate(values):
                bounds = [0, len(value)]
                if cut and i == len(values) - 1:
                    bounds = [0, *(x for m in cut.finditer(value) for x in m.span()), len(value)]
                for k in range(0, len(bounds), 2):
                    size = len(value[bounds[k]:bounds[k + 1]].encode())
                    spans.append((at, at + size))
                    names.append((fields[i], k // 2))
                    chars.append((bounds[k], bounds[k + 1]))
                    at += size + (len(value[bounds[k + 1]:bounds[k + 2]].encode()) if k + 2 < len(bounds) else 0)
                at += gap
            ends = encoder.ends(separator.join(values))
            own, crosses = join_spans(ends, np.array(spans, np.int64), rule)
            n = len(spans)
            parts["id"] += [doc] * n
            parts["field"] += [f for f, _ in names]
            parts["section"] += [s for _, s in names]
            parts["start"] += [s for s, _ in chars]
            parts["end"] += [e for _, e in chars]
            parts["n_tokens"] += np.bincount(own, minlength=n).tolist()
            parts["n_crossing"] += np.bincount(own[crosses], minlength=n).tolist()
            parts["doc_tokens"] += [len(ends)] * n
        return parts

    out = map_arrow(rows, count, "id long, field string, section long, start long, end long, n_tokens long, "
                                 "n_crossing long, doc_tokens long")
    return out.withColumnRenamed("id", id_col)


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
