"""A join that sets hot keys apart."""

import pytest
from pyspark.sql import functions as F

from cinerank.llm.common import skew_join, stage


@pytest.mark.parametrize("hot", [0, 5000])
@pytest.mark.parametrize("kind", ["long", "binary"])
def test_hot_keys_are_told_by_a_list(spark, hot, kind):
    """Rows of hot and of other keys, null keys and keys without a partner as in a plain
    join; rows of other keys are not told from hot ones by a join of their own."""
    key = F.col("key").cast("string").cast("binary") if kind == "binary" else F.col("key")
    keys = [(i % 700 + 1, i) for i in range(1400)] + [(0, i) for i in range(hot)] + [(None, 1), (9999, 2)]
    rows = stage(spark.createDataFrame(keys, "key long, x long").withColumn("key", key))
    table = stage(rows.where("x <> 2 or x is null").groupBy("key").agg(F.count("*").alias("n")).where("key is not null"))
    got, want = skew_join(rows, table, "key", "n"), rows.join(table, "key")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() >= hot
    assert "LeftAnti" not in got._jdf.queryExecution().optimizedPlan().toString()
