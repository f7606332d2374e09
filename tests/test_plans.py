"""Plan-shape regressions: what .explain() must (not) show for key queries."""

import io
import re
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan_of(spark, key):
    buf = io.StringIO()
    with redirect_stdout(buf):
        entry.queries()[key](spark, SF).explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", ["recommend_all", "similar_users", "rating_metrics",
                                 "split_rows_exact", "predict_batch_zero_fill", "evaluation_report"])
def test_no_cartesian_or_nested_loop(spark, key):
    plan = plan_of(spark, key)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("key", ["similar_users", "recommend_all"])
def test_top_k_is_a_group_limit(spark, key):
    assert "WindowGroupLimit" in plan_of(spark, key)


def test_scan_reads_only_needed_columns(spark):
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan_of(spark, "soft_range_count"))
    assert schemas == ["struct<value:double>"]


def test_only_python_is_the_grid_kernel(spark):
    from cinerank.operators.similarity import Layout, cosine_similarity
    from cinerank.plans.context import r1_cells
    buf = io.StringIO()
    with redirect_stdout(buf):
        cosine_similarity(r1_cells(spark, SF), layout=Layout(False, 2, 2)).explain("formatted")
    assert "FlatMapGroupsInPandas" in buf.getvalue()
    buf = io.StringIO()
    with redirect_stdout(buf):
        cosine_similarity(r1_cells(spark, SF), layout=Layout(True)).explain("formatted")
    assert "Pandas" not in buf.getvalue() and "Arrow" not in buf.getvalue()
    assert "FlatMapGroupsInPandas" not in plan_of(spark, "validation_report")
