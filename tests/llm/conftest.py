import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators also use inside or in their results.
CLASHING = ("size", "taken", "target", "kept", "keep_id", "digest", "component_id", "sequence_id", "start",
            "score", "label", "line", "key", "count", "value", "node", "u", "v")


@pytest.fixture
def docs(spark):
    """Make a documents table from (doc_id, text[, source]) rows."""
    def make(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F
            for c in CLASHING:
                df = df.withColumn(c, F.lit("clash"))
        return df
    return make
