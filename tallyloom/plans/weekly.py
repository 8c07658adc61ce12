"""The weekly run as one lazy plan: snapshots, true weeks, ranks, deltas and flags; only sinks act."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions import kpi
from tallyloom.operators import enrich, ledger
from tallyloom.operators.cumulative import month_to_date, weekly
from tallyloom.sources import facts


def enriched_weeks(weeks: DataFrame) -> DataFrame:
    """Differenced weeks with ratios, ranks within the week, deltas to the week before, and flags."""
    rows = kpi.with_ratios(weeks)
    rows = enrich.ranks(rows, ["pph", "total_sales"], ["week_ending"], "loc_name")
    return enrich.z_flags(enrich.deltas(rows, ["total_sales", "pph"], ["loc_name"]), "pph", ["week_ending"])


def run(spark: SparkSession, folder: str, target: str) -> dict[str, int]:
    """Writes new snapshots to the ledger at target/mtd and all weeks, by month, to target/weeks. Running it again appends nothing."""
    snapshots = month_to_date(facts.location_weeks(spark, folder), ["loc_name"])
    done = ledger.append_ledger(spark, f"{target}/mtd", snapshots, ["loc_name", "year_month", "week_ending"], "guests")
    ledger.overwrite_snapshot(enriched_weeks(weekly(spark.read.parquet(f"{target}/mtd"), ["loc_name"])), f"{target}/weeks", by="year_month")
    return done


def weekly_pipeline(spark, sf_dir):
    rows = enriched_weeks(weekly(month_to_date(facts.location_weeks(spark, sf_dir), ["loc_name"]), ["loc_name"]))
    return kpi.plain(rows, ["loc_name", "week_ending", "total_sales", "pph", "rank_pph", "rank_total_sales", "delta_total_sales", "flag"])


QUERIES = {"weekly_pipeline": weekly_pipeline}
ORACLE = {
    "weekly_pipeline": f"""WITH {facts.WEEKS_SQL}, k AS (SELECT loc_name, week_ending, service + product AS total_sales, {kpi.ratios_sql(kpi.LOCATION_RATIOS[2:3])} FROM lw),
s AS (SELECT week_ending, avg(pph) FILTER (pph > 0) AS mean, coalesce(stddev_samp(pph) FILTER (pph > 0), 1.0) AS sd FROM k GROUP BY 1),
z AS (SELECT k.*, CASE WHEN pph > 0 THEN CASE WHEN sd = 0 THEN 0.0 ELSE (pph - mean) / sd END END AS z FROM k JOIN s USING (week_ending))
SELECT loc_name, week_ending, total_sales::DOUBLE AS total_sales, pph, row_number() OVER (PARTITION BY week_ending ORDER BY pph DESC, loc_name)::BIGINT AS rank_pph, row_number() OVER (PARTITION BY week_ending ORDER BY total_sales DESC, loc_name)::BIGINT AS rank_total_sales,
  (total_sales - lag(total_sales) OVER (PARTITION BY loc_name ORDER BY week_ending))::DOUBLE AS delta_total_sales, CASE WHEN z >= 1 THEN 'star' WHEN z <= -1 THEN 'watch' ELSE 'solid' END AS flag FROM z"""
}
