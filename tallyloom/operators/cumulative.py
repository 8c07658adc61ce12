"""Month-to-date snapshots and the true weekly figures within them.

A snapshot holds running totals that start again each month. One shuffle by entity and month gives both directions: a running sum makes
snapshots of weeks, a lag makes weeks of snapshots. Negative weeks, from refunds, are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import kpi
from tallyloom.sources import facts
from tallyloom.sources.facts import ADDITIVE

WEEK = "week_ending"


def _within_month(keys: list[str]) -> Window:
    return Window.partitionBy(*keys, "year_month").orderBy(WEEK)


def month_to_date(weeks: DataFrame, keys: list[str], fields: list[str] = ADDITIVE) -> DataFrame:
    """weeks with each field replaced by its running total within the month."""
    w = _within_month(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return weeks.withColumns({f: F.sum(f).over(w) for f in fields})


def weekly(snapshots: DataFrame, keys: list[str], fields: list[str] = ADDITIVE) -> DataFrame:
    """snapshots with each field replaced by its difference from the snapshot before it in the month; the first stays as it is."""
    w = _within_month(keys)
    return snapshots.withColumns({f: F.col(f) - F.coalesce(F.lag(f).over(w), F.lit(0)) for f in fields})


def latest_prior(snapshots: DataFrame, keys: list[str], before: Column, fields: list[str]) -> DataFrame:
    """One row per keys: the latest snapshot strictly before a week."""
    last = F.max_by(F.struct(WEEK, *fields), WEEK)
    return snapshots.where(F.col(WEEK) < before).groupBy(*keys).agg(last.alias("p")).select(*keys, "p.*")


def week_in_month(snapshots: DataFrame) -> DataFrame:
    """snapshots with week_idx, 1 for a month's first week that any entity has. Weeks are few: they are ranked apart and joined back."""
    weeks = snapshots.select("year_month", WEEK).distinct()
    ranked = weeks.withColumn("week_idx", F.row_number().over(Window.partitionBy("year_month").orderBy(WEEK)))
    return snapshots.join(ranked, ["year_month", WEEK])


KEYS, STYLIST_KEYS = ["loc_name", WEEK, "year_month"], ["stylist_name", "loc_name", WEEK, "year_month"]
COUNTS = ["wax_count", "treat_count", "wax", "color", "treat"]
_COUNTS_SQL = "wax_count::BIGINT AS wax_count, treat_count::BIGINT AS treat_count, wax::DOUBLE AS wax, color::DOUBLE AS color, treat::DOUBLE AS treat"


def location_week_kpis(spark, sf_dir):
    return kpi.plain(kpi.with_ratios(facts.location_weeks(spark, sf_dir)), [*KEYS, "platform", *kpi.FIGURES, *COUNTS, *kpi.ALL_RATIOS])


def stylist_week_kpis(spark, sf_dir):
    return kpi.plain(kpi.with_ratios(facts.stylist_weeks(spark, sf_dir), kpi.STYLIST_RATIOS), [*STYLIST_KEYS, *kpi.FIGURES, *(r[0] for r in kpi.STYLIST_RATIOS)])


def kpi_null_safe_div(spark, sf_dir):
    """Weekly figures of product lines alone: services are zero, so service ratios are null."""
    rows = facts.totals(facts.lines(spark, sf_dir).where("p_type = 'PROMO'"), ["loc_name", WEEK])
    return kpi.plain(kpi.with_ratios(rows, empty=kpi.NULL), ["loc_name", WEEK, *kpi.FIGURES, *kpi.ALL_RATIOS])


def cumulative_mtd(spark, sf_dir):
    return kpi.plain(kpi.with_ratios(month_to_date(facts.location_weeks(spark, sf_dir), ["loc_name"])), [*KEYS, *kpi.FIGURES, *COUNTS, *kpi.ALL_RATIOS])


def weekly_from_cumulative(spark, sf_dir):
    snapshots = month_to_date(facts.location_weeks(spark, sf_dir), ["loc_name"])
    return kpi.plain(kpi.with_ratios(weekly(snapshots, ["loc_name"])), [*KEYS, *kpi.FIGURES, *COUNTS, *kpi.ALL_RATIOS])


def stylist_weekly_from_cumulative(spark, sf_dir):
    keys = ["stylist_name", "loc_name"]
    return kpi.plain(kpi.with_ratios(weekly(month_to_date(facts.stylist_weeks(spark, sf_dir), keys), keys), kpi.STYLIST_RATIOS), [*STYLIST_KEYS, *kpi.FIGURES, *(r[0] for r in kpi.STYLIST_RATIOS)])


def latest_prior_snapshot(spark, sf_dir):
    """For every location and month, the snapshot before the month's last week."""
    s = month_to_date(facts.location_weeks(spark, sf_dir), ["loc_name"])
    last = s.groupBy("year_month").agg(F.max(WEEK).alias("current_week"))
    out = latest_prior(s.join(last, "year_month"), ["loc_name", "year_month", "current_week"], F.col("current_week"), ["guests", "service", "product", "prod_hours"])
    return kpi.plain(out, ["loc_name", "year_month", "current_week", WEEK, "guests", "service", "product", "prod_hours"])


def refund_negative_week(spark, sf_dir):
    """Returned lines count against their week, so weeks and differences may be negative."""
    rows = facts.lines(spark, sf_dir).withColumn("net", F.when(F.col("l_returnflag") == "R", -F.col("net")).otherwise(F.col("net")))
    weeks = facts.totals(rows, ["loc_name", WEEK]).withColumn("year_month", facts.year_month(F.col(WEEK)))
    out = weekly(month_to_date(weeks, ["loc_name"]), ["loc_name"]).where("service + product < 0")
    return kpi.plain(kpi.with_ratios(out), [*KEYS, *kpi.FIGURES, "avg_ticket", "pph"])


def week_ordinal_in_month(spark, sf_dir):
    return kpi.plain(week_in_month(facts.location_weeks(spark, sf_dir)), [*KEYS, "week_idx"])


QUERIES = {f.__name__: f for f in (location_week_kpis, stylist_week_kpis, kpi_null_safe_div, cumulative_mtd, weekly_from_cumulative, stylist_weekly_from_cumulative, latest_prior_snapshot, refund_negative_week, week_ordinal_in_month)}

_RUNNING = ", ".join(f"sum({f}) OVER w AS {f}" for f in ADDITIVE)
_MTD_SQL = f"{facts.WEEKS_SQL},\nmtd AS (SELECT loc_name, week_ending, year_month, {_RUNNING} FROM lw WINDOW w AS (PARTITION BY loc_name, year_month ORDER BY week_ending))"
_KEYS_SQL = "loc_name, week_ending, year_month"
ORACLE = {
    "location_week_kpis": f"WITH {facts.WEEKS_SQL} SELECT {_KEYS_SQL}, platform, {kpi.MONEY_SQL}, {_COUNTS_SQL}, {kpi.ratios_sql()} FROM lw",
    "stylist_week_kpis": f"WITH {facts.STYLISTS_SQL} SELECT stylist_name, {_KEYS_SQL}, {kpi.MONEY_SQL}, {kpi.ratios_sql(kpi.STYLIST_RATIOS)} FROM sw",
    "kpi_null_safe_div": f"WITH {facts.LINES_SQL}, t AS ({facts.totals_sql('loc_name, week_ending', 'lines WHERE p_type = ' + repr('PROMO'))}) SELECT loc_name, week_ending, {kpi.MONEY_SQL}, {kpi.ratios_sql(empty=kpi.NULL)} FROM t",
    "cumulative_mtd": f"WITH {_MTD_SQL} SELECT {_KEYS_SQL}, {kpi.MONEY_SQL}, {_COUNTS_SQL}, {kpi.ratios_sql()} FROM mtd",
    "weekly_from_cumulative": f"WITH {facts.WEEKS_SQL} SELECT {_KEYS_SQL}, {kpi.MONEY_SQL}, {_COUNTS_SQL}, {kpi.ratios_sql()} FROM lw",
    "stylist_weekly_from_cumulative": f"WITH {facts.STYLISTS_SQL} SELECT stylist_name, {_KEYS_SQL}, {kpi.MONEY_SQL}, {kpi.ratios_sql(kpi.STYLIST_RATIOS)} FROM sw",
    "latest_prior_snapshot": f"""WITH {_MTD_SQL}, last AS (SELECT year_month, max(week_ending) AS current_week FROM lw GROUP BY 1),
p AS (SELECT *, row_number() OVER (PARTITION BY loc_name, year_month ORDER BY week_ending DESC) AS rn FROM mtd JOIN last USING (year_month) WHERE week_ending < current_week)
SELECT loc_name, year_month, current_week, week_ending, guests::BIGINT AS guests, service::DOUBLE AS service, product::DOUBLE AS product, prod_hours::DOUBLE AS prod_hours FROM p WHERE rn = 1""",
    "refund_negative_week": f"""WITH {facts.LINES_SQL}, r AS (SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN -net ELSE net END AS net) FROM lines),
t AS (SELECT *, strftime(week_ending, '%Y-%m') AS year_month FROM ({facts.totals_sql('loc_name, week_ending', 'r')}))
SELECT * FROM (SELECT {_KEYS_SQL}, {kpi.MONEY_SQL}, {kpi.ratios_sql(tuple(r for r in kpi.LOCATION_RATIOS if r[0] in ('avg_ticket', 'pph')))} FROM t) WHERE total_sales < 0""",
    "week_ordinal_in_month": f"WITH {facts.WEEKS_SQL} SELECT {_KEYS_SQL}, dense_rank() OVER (PARTITION BY year_month ORDER BY week_ending)::BIGINT AS week_idx FROM lw",
}
