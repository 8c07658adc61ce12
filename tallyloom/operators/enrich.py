"""Ranks, deltas, flags, thresholds and archetypes.

Network-wide figures are scalar aggregates attached as one-row subqueries, so no window over a whole table lands in one task; ranks are
within a week. Ranks are sequential: equal values are told apart by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import kpi
from tallyloom.sources import facts

WEEK = "week_ending"
STAR, WATCH, STAR_PERCENTILE, PRODUCT_EDGE, PPH_GAP = 1.0, -1.0, 85, 1.2, -8.0


def ranks(df: DataFrame, metrics: list[str], within: list[str], name: str) -> DataFrame:
    """df with rank_<metric>, 1 for the largest."""
    w = lambda m: Window.partitionBy(*within).orderBy(F.col(m).desc(), name)
    return df.withColumns({f"rank_{m}": F.row_number().over(w(m)) for m in metrics})


def deltas(df: DataFrame, metrics: list[str], keys: list[str]) -> DataFrame:
    """df with prior_<metric>, the value of the entity's week before, its difference, and that as a share of the prior (null if that is 0)."""
    w = Window.partitionBy(*keys).orderBy(WEEK)
    df = df.withColumns({f"prior_{m}": F.lag(m).over(w) for m in metrics})
    change = {f"delta_{m}": F.col(m) - F.col(f"prior_{m}") for m in metrics}
    share = {f"delta_pct_{m}": F.try_divide((F.col(m) - F.col(f"prior_{m}")).cast("double"), F.abs(f"prior_{m}").cast("double")) for m in metrics}
    return df.withColumns({**change, **share})


def nearest_rank(metric: str, percent: int) -> Column:
    """Aggregate: the value at index floor(n * percent / 100), at most the last, of the sorted values. For few values; else see at_rank."""
    values = F.array_sort(F.collect_list(metric))
    n = F.count(metric)
    return F.get(values, F.least(F.floor(n * percent / 100), n - 1).cast("int"))


def at_rank(df: DataFrame, within: list[str], metric: str, percent: int) -> DataFrame:
    """(within, metric, n): what nearest_rank gives for each of `within`, by ranks that can spill instead of an array of all values."""
    w = Window.partitionBy(*within)
    rows = df.where(F.col(metric).isNotNull()).withColumns({"_r": F.row_number().over(w.orderBy(metric)), "n": F.count("*").over(w)})
    return rows.where(F.col("_r") == F.least(F.floor(F.col("n") * percent / 100), F.col("n") - 1) + 1).select(*within, metric, "n")


def z_flags(df: DataFrame, metric: str, within: list[str]) -> DataFrame:
    """df with z and flag: the distance from the mean of positive values in sample standard deviations (1 for a single value; 0 if they are equal)."""
    of = F.when(F.col(metric) > 0, F.col(metric))
    stats = df.groupBy(*within).agg(F.avg(of).alias("mean"), F.coalesce(F.stddev_samp(of), F.lit(1.0)).alias("sd"))
    z = F.when(F.col("sd") == 0, 0.0).otherwise((F.col(metric) - F.col("mean")) / F.col("sd"))
    out = df.join(stats, within).withColumn("z", F.when(F.col(metric) > 0, z))
    return out.withColumn("flag", F.when(F.col("z") >= STAR, "star").when(F.col("z") <= WATCH, "watch").otherwise("solid"))


def _weeks(spark, sf_dir):
    return kpi.with_ratios(facts.location_weeks(spark, sf_dir))


def rank_locations(spark, sf_dir):
    metrics = ["pph", "total_sales", "product_pct", "guests"]
    return kpi.plain(ranks(_weeks(spark, sf_dir), metrics, [WEEK], "loc_name"), ["loc_name", WEEK, *(f"rank_{m}" for m in metrics)])


def wow_deltas(spark, sf_dir):
    metrics = ["total_sales", "guests", "pph"]
    return kpi.plain(deltas(_weeks(spark, sf_dir), metrics, ["loc_name"]), ["loc_name", WEEK, *metrics, *(f"{p}{m}" for m in metrics for p in ("prior_", "delta_", "delta_pct_"))])


def zscore_flags(spark, sf_dir):
    """Flags of service per hour against the other locations of the week. z is rounded, as sums of doubles depend on their order."""
    return z_flags(_weeks(spark, sf_dir), "pph", [WEEK]).select("loc_name", WEEK, F.round("z", 6).alias("z"), "flag")


def star_threshold_nearest_rank(spark, sf_dir):
    rows = kpi.with_ratios(facts.stylist_weeks(spark, sf_dir), kpi.STYLIST_RATIOS).where("pph > 0")
    return at_rank(rows, [WEEK], "pph", STAR_PERCENTILE).select(WEEK, F.col("pph").alias("star_threshold"), F.col("n").alias("n_stylists"))


def stylist_archetypes(spark, sf_dir):
    """Each stylist-week's archetype, against its week's threshold and network averages."""
    rows = kpi.with_ratios(facts.stylist_weeks(spark, sf_dir), kpi.STYLIST_RATIOS)
    week = rows.where("pph > 0").groupBy(WEEK).agg(F.round(F.avg("pph"), 7).alias("net_pph"), F.round(F.avg("product_pct"), 7).alias("net_product_pct"))
    week = week.join(at_rank(rows.where("pph > 0"), [WEEK], "pph", STAR_PERCENTILE).select(WEEK, F.col("pph").alias("star_threshold")), WEEK)
    kind = F.when((F.col("pph") > 0) & (F.col("pph") >= F.col("star_threshold")), "star").when(F.col("product_pct") >= PRODUCT_EDGE * F.col("net_product_pct"), "seller").when(F.col("pph") - F.col("net_pph") <= PPH_GAP, "needs_support").otherwise("steady")
    return rows.join(week, WEEK).select("stylist_name", "loc_name", WEEK, "pph", "product_pct", "star_threshold", kind.alias("archetype"))


def network_summary(spark, sf_dir):
    """One row a week: sums, averages over positive values, and the best and the last location by service per hour."""
    rows = ranks(_weeks(spark, sf_dir), ["pph"], [WEEK], "loc_name")
    pos = lambda m: F.round(F.avg(F.when(F.col(m) > 0, F.col(m))), 7)
    out = rows.groupBy(WEEK).agg(F.count("*").alias("n_locations"), F.sum("guests").alias("guests"), F.sum("total_sales").alias("total_sales"), pos("pph").alias("avg_pph"), pos("ppg").alias("avg_ppg"), pos("product_pct").alias("avg_product_pct"), F.min_by("loc_name", "rank_pph").alias("top_location"), F.max_by("loc_name", "rank_pph").alias("bottom_location"))
    return kpi.plain(out, out.columns)


def trailing3_pph(spark, sf_dir):
    w = Window.partitionBy("loc_name").orderBy(WEEK).rowsBetween(-2, 0)
    rows = facts.location_weeks(spark, sf_dir).withColumns({f"{c}3": F.sum(c).over(w) for c in ("service", "prod_hours")}).withColumn("n_weeks", F.count("*").over(w))
    return rows.select("loc_name", WEEK, kpi.ratio(F.col("service3"), F.col("prod_hours3")).alias("pph_3wk"), "n_weeks")


QUERIES = {f.__name__: f for f in (rank_locations, wow_deltas, zscore_flags, star_threshold_nearest_rank, stylist_archetypes, network_summary, trailing3_pph)}

_R = kpi.ratios_sql()
_LK = f"{facts.WEEKS_SQL}, lk AS (SELECT loc_name, manager, platform, year_month, week_ending, guests, service, product, service + product AS total_sales, prod_hours, {_R} FROM lw)"
_SK = f"{facts.STYLISTS_SQL}, sk AS (SELECT stylist_name, loc_name, year_month, week_ending, guests, service, product, service + product AS total_sales, prod_hours, {kpi.ratios_sql(kpi.STYLIST_RATIOS)} FROM sw)"
_PICK = "list_sort(list(pph))[least(count(*) * 85 // 100, count(*) - 1) + 1]"
ORACLE = {
    "rank_locations": f"WITH {_LK} SELECT loc_name, week_ending, " + ", ".join(f"row_number() OVER (PARTITION BY week_ending ORDER BY {m} DESC, loc_name)::BIGINT AS rank_{m}" for m in ("pph", "total_sales", "product_pct", "guests")) + " FROM lk",
    "wow_deltas": f"WITH {_LK}, p AS (SELECT *, " + ", ".join(f"lag({m}) OVER w AS prior_{m}" for m in ("total_sales", "guests", "pph")) + " FROM lk WINDOW w AS (PARTITION BY loc_name ORDER BY week_ending)) SELECT loc_name, week_ending, total_sales::DOUBLE AS total_sales, guests::BIGINT AS guests, pph, " + ", ".join(f"prior_{m}::{t} AS prior_{m}, ({m} - prior_{m})::{t} AS delta_{m}, ({m} - prior_{m})::DOUBLE / nullif(abs(prior_{m})::DOUBLE, 0) AS delta_pct_{m}" for m, t in (("total_sales", "DOUBLE"), ("guests", "BIGINT"), ("pph", "DOUBLE"))) + " FROM p",
    "zscore_flags": f"""WITH {_LK}, s AS (SELECT week_ending, avg(pph) FILTER (pph > 0) AS mean, coalesce(stddev_samp(pph) FILTER (pph > 0), 1.0) AS sd FROM lk GROUP BY 1),
z AS (SELECT loc_name, lk.week_ending, CASE WHEN pph > 0 THEN CASE WHEN sd = 0 THEN 0.0 ELSE (pph - mean) / sd END END AS z FROM lk JOIN s USING (week_ending))
SELECT loc_name, week_ending, round(z, 6) AS z, CASE WHEN z >= 1 THEN 'star' WHEN z <= -1 THEN 'watch' ELSE 'solid' END AS flag FROM z""",
    "star_threshold_nearest_rank": f"WITH {_SK} SELECT week_ending, {_PICK} AS star_threshold, count(*) AS n_stylists FROM sk WHERE pph > 0 GROUP BY 1",
    "stylist_archetypes": f"""WITH {_SK}, w AS (SELECT week_ending, {_PICK} AS star_threshold, round(avg(pph), 7) AS net_pph, round(avg(product_pct), 7) AS net_product_pct FROM sk WHERE pph > 0 GROUP BY 1)
SELECT stylist_name, loc_name, week_ending, pph, product_pct, star_threshold, CASE WHEN pph > 0 AND pph >= star_threshold THEN 'star' WHEN product_pct >= {PRODUCT_EDGE}::DOUBLE * net_product_pct THEN 'seller' WHEN pph - net_pph <= {PPH_GAP} THEN 'needs_support' ELSE 'steady' END AS archetype FROM sk JOIN w USING (week_ending)""",
    "network_summary": f"""WITH {_LK}, r AS (SELECT *, row_number() OVER (PARTITION BY week_ending ORDER BY pph DESC, loc_name) AS k FROM lk)
SELECT week_ending, count(*) AS n_locations, sum(guests)::BIGINT AS guests, sum(total_sales)::DOUBLE AS total_sales, round(avg(pph) FILTER (pph > 0), 7) AS avg_pph, round(avg(ppg) FILTER (ppg > 0), 7) AS avg_ppg, round(avg(product_pct) FILTER (product_pct > 0), 7) AS avg_product_pct, arg_min(loc_name, k) AS top_location, arg_max(loc_name, k) AS bottom_location FROM r GROUP BY 1""",
    "trailing3_pph": f"WITH {facts.WEEKS_SQL} SELECT loc_name, week_ending, coalesce((sum(service) OVER w)::DOUBLE / nullif((sum(prod_hours) OVER w)::DOUBLE, 0), 0.0) AS pph_3wk, count(*) OVER w AS n_weeks FROM lw WINDOW w AS (PARTITION BY loc_name ORDER BY week_ending ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
}
