"""What plans must not hold, and small functions that queries rest on."""

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import kpi, parsing
from tallyloom.operators import contracts, emit, parsed
from tallyloom.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["report_week_kpi_block", "dashboard_cards", "transfer_impact_prepost", "around_moves", "employee_totals", "location_payload"])
def test_no_cartesian_products(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["roster_full_outer_merge", "manager_filter", "history_merge_monthly_weekly", "report_week_kpi_block", "transfer_audit_trail", "transfer_corrections"])
def test_the_fact_table_is_read_before(spark, name):
    """What several legs need is stored, so their plan has no scan of the lines left."""
    assert "l_shipdate" not in plan(QUERIES[name](spark, FOLDER)) and "l_orderkey" not in plan(QUERIES[name](spark, FOLDER))


def test_columns_are_pruned_at_the_scan(spark):
    text = plan(QUERIES["months_by_list"](spark, FOLDER))
    assert "l_tax" not in text and "l_shipdate" in text


@pytest.mark.parametrize(("x", "digits", "want"), [(2.5, 0, 3.0), (-2.5, 0, -2.0), (1.005, 1, 1.0), (0.125, 2, 0.13), (None, 2, None)])
def test_rounding_is_half_up(spark, x, digits, want):
    assert spark.range(1).select(kpi.rounded(F.lit(x).cast("double"), digits)).first()[0] == want


def test_means_do_not_depend_on_order(spark):
    rows = [(0.1 * i,) for i in range(1000)]
    a, b = (spark.createDataFrame(r, "x double").repartition(n).agg(kpi.mean(F.col("x"))).first()[0] for r, n in ((rows, 1), (rows[::-1], 7)))
    assert a == b and abs(a - 49.95) < 1e-6
    assert spark.createDataFrame([], "x double").agg(kpi.mean(F.col("x"))).first()[0] is None


def test_strict_parsers_raise(spark):
    df = spark.createDataFrame([("$1.50",), ("",), (None,)], "t string")
    of = parsed.strict(parsing.money(F.col("t")), F.col("t"), "an amount")
    assert [None if r[0] is None else float(r[0]) for r in df.select(of).collect()] == [1.5, None, None]
    with pytest.raises(Exception, match="not an amount: x"):
        spark.createDataFrame([("x",)], "t string").select(of).collect()


def test_replacing_tails(spark):
    df = spark.createDataFrame([([1, 2], 9), ([1, 2], None), ([], 9), ([5], None)], "a array<int>, v int")
    assert [r[0] for r in df.select(emit.replace_tail(F.col("a"), F.col("v"))).collect()] == [[1, 9], [1], [], []]


def test_replies_without_a_list_give_none(spark):
    df = spark.createDataFrame([('ok [{"id":1}] bye',), ("none",), ("[broken",), (None,)], "t string")
    assert [[x.id for x in r[0]] for r in df.select(emit.json_rows(F.col("t"), "struct<id:bigint>")).collect()] == [[1], [], [], []]


def test_places_and_period_starts(spark):
    df = spark.createDataFrame([(" Main ", "2024-03-10"), ("MN", "3/10/2024"), (None, "10-Mar-2024"), ("x", "soon"), ("x", None)], "p string, d string")
    got = df.select(contracts.place(F.col("p"), {"mn": "Main"}), contracts.period_start(F.col("d"))).collect()
    assert [r[0] for r in got] == ["Main", "Main", "Unknown", "x", "x"] and [r[1] for r in got] == ["2024-03-04"] * 3 + ["soon", ""]
