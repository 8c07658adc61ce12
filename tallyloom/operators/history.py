"""History: the last weeks of each entity, monthly and weekly series side by side, trends, and changes of shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import kpi
from tallyloom.sources import facts
from tallyloom.sources.work import stored, work_folder

WEEK, WEEKS = "week_ending", 12


def last_n(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """The last n rows of each entity, with age 1 for the newest."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("age", F.row_number().over(w)).where(F.col("age") <= n)


def series(values: str, order: str) -> Column:
    """Aggregate: values as an array, oldest first."""
    return F.transform(F.sort_array(F.collect_list(F.struct(order, values))), lambda x: x[values])


def pad_left(array: Column, n: int, fill: float = 0.0) -> Column:
    """array with fill put before it up to n elements."""
    return F.concat(F.array_repeat(F.lit(fill), F.greatest(F.lit(0), F.lit(n) - F.size(array))), array)


def text_series(array: Column) -> Column:
    return F.array_join(F.transform(array, lambda x: x.cast("string")), ",")


def last_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """Rows of the last n distinct periods. The periods, few, are ranked apart."""
    top = df.select(period).distinct().orderBy(F.col(period).desc()).limit(n)
    return df.join(top, period, "left_semi")


def merge_grains(weekly: DataFrame, monthly: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Weekly and monthly rows in one long table with their grain, the last n points of each entity; monthly points come before weekly ones."""
    both = monthly.withColumn("grain", F.lit("month")).unionByName(weekly.withColumn("grain", F.lit("week")))
    w = Window.partitionBy(*keys).orderBy(F.col("grain").desc(), F.col("point").desc())
    return both.withColumn("age", F.row_number().over(w)).where(F.col("age") <= n)


def monthly_trend(df: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """The largest positive value of each month, which for snapshots is the month so far; months without one are left out."""
    out = df.groupBy(*keys, "year_month").agg(F.max(metric).alias(metric)).where(F.col(metric) > 0)
    return out.withColumn("label", F.date_format(F.to_date(F.concat("year_month", F.lit("-01"))), "MMM yyyy"))


def year_over_year(months: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """months with the same month of the year before and the relative change; null where that month is absent or zero."""
    before = months.select(*keys, F.col(metric).alias("prior_year"), F.concat((F.substring("year_month", 1, 4).cast("int") + 1).cast("string"), F.substring("year_month", 5, 3)).alias("year_month"))
    out = months.join(before, [*keys, "year_month"], "left")
    return out.withColumn("yoy_pct", F.try_divide((F.col(metric) - F.col("prior_year")).cast("double"), F.col("prior_year").cast("double")))


def rosters(now: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """Everyone in either table: figures of both, 0 where absent, and who is only in the earlier one."""
    out = now.join(before, keys, "full").withColumn("only_before", F.col("now").isNull())
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("now", "before")})


def history_last12(spark, sf_dir):
    rows = last_n(kpi.with_ratios(facts.location_weeks(spark, sf_dir)), ["loc_name"], WEEK, WEEKS)
    out = rows.groupBy("loc_name").agg(F.count("*").alias("n_weeks"), F.min(WEEK).alias("first_week"), F.max(WEEK).alias("last_week"), series("guests", WEEK).alias("g"))
    return out.select("loc_name", "n_weeks", "first_week", "last_week", text_series(F.col("g")).alias("guests"), text_series(F.transform(pad_left(F.slice("g", -3, 3), 5), lambda x: x.cast("long"))).alias("guests_padded"))


def history_merge_monthly_weekly(spark, sf_dir):
    """The last 12 points of each location: whole months up to the last but one, then weeks of the last two months."""
    figures = ["guests", "service", "product"]
    weeks = stored(facts.location_weeks(spark, sf_dir).select("loc_name", "year_month", WEEK, *figures), work_folder(spark))  # the fact table is read once
    months = weeks.groupBy("loc_name", "year_month").agg(*(F.sum(c).alias(c) for c in figures))
    edge = weeks.select(F.max("year_month")).scalar()
    recent = F.col("year_month") >= F.date_format(F.add_months(F.to_date(F.concat(edge, F.lit("-01"))), -1), "yyyy-MM")
    w = weeks.where(recent).select("loc_name", F.col(WEEK).alias("point"), "guests", "service", "product")
    m = months.where(~recent).select("loc_name", F.last_day(F.to_date(F.concat("year_month", F.lit("-01")))).alias("point"), "guests", "service", "product")
    return kpi.plain(merge_grains(w, m, ["loc_name"], WEEKS), ["loc_name", "grain", "point", "age", "guests", "service", "product"])


def roster_full_outer_merge(spark, sf_dir):
    """Stylists of the last two months."""
    rows = facts.stylist_weeks(spark, sf_dir).groupBy("stylist_name", "loc_name", "year_month").agg(F.sum("guests").alias("guests"))
    rows = stored(rows, work_folder(spark))
    top = last_periods(rows.select("year_month"), "year_month", 2).agg(F.max("year_month").alias("now"), F.min("year_month").alias("before"))
    of = lambda which: rows.where(F.col("year_month") == top.select(which).scalar()).groupBy("stylist_name", "loc_name").agg(F.sum("guests").alias(which))
    return rosters(of("now"), of("before"), ["stylist_name", "loc_name"])


def monthly_trend_max(spark, sf_dir):
    from tallyloom.operators.cumulative import month_to_date

    snapshots = kpi.with_ratios(month_to_date(facts.location_weeks(spark, sf_dir), ["loc_name"]))
    return kpi.plain(monthly_trend(snapshots, ["loc_name"], "total_sales"), ["loc_name", "year_month", "label", "total_sales"])


def yoy_compare(spark, sf_dir):
    rows = year_over_year(kpi.with_ratios(facts.location_months(spark, sf_dir)), ["loc_name"], "total_sales")
    return kpi.plain(rows, ["loc_name", "year_month", "total_sales", "prior_year", "yoy_pct"])


def baseline_last_n_periods(spark, sf_dir):
    """Averages of each location over the last four weeks that any location has."""
    rows = last_periods(kpi.with_ratios(facts.location_weeks(spark, sf_dir)), WEEK, 4)
    out = rows.groupBy("loc_name").agg(F.count("*").alias("n_weeks"), *(F.sum(c).alias(c) for c in ("total_sales", "guests", "wax_count", "treat_count")))
    n = F.col("n_weeks")
    return out.select("loc_name", "n_weeks", *(kpi.ratio(F.col(c), n).alias(f"avg_{c}") for c in ("total_sales", "guests", "wax_count", "treat_count")))


def unpivot_yoy(spark, sf_dir):
    """One row a location, month and year, from a table with a column a year."""
    months = kpi.with_ratios(facts.location_months(spark, sf_dir)).select("loc_name", F.substring("year_month", 6, 2).alias("month"), F.substring("year_month", 1, 4).alias("year"), F.col("total_sales").cast("double").alias("total_sales"))
    wide = months.groupBy("loc_name", "month").pivot("year").agg(F.sum("total_sales"))  # the years that the table has
    years = [c for c in wide.columns if c not in ("loc_name", "month")]
    return wide.unpivot(["loc_name", "month"], years, "year", "total_sales").where("total_sales IS NOT NULL")


def pivot_weeks(spark, sf_dir):
    """A column for each week of the month."""
    from tallyloom.operators.cumulative import week_in_month

    rows = week_in_month(kpi.with_ratios(facts.location_weeks(spark, sf_dir)))
    out = rows.groupBy("loc_name", "year_month").pivot("week_idx", [1, 2, 3, 4, 5, 6]).agg(F.sum("total_sales").cast("double"))
    return out.withColumnsRenamed({str(i): f"week_{i}" for i in range(1, 7)})


QUERIES = {f.__name__: f for f in (history_last12, history_merge_monthly_weekly, roster_full_outer_merge, monthly_trend_max, yoy_compare, baseline_last_n_periods, unpivot_yoy, pivot_weeks)}
ORACLE = {
    "history_last12": f"""WITH {facts.WEEKS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY loc_name ORDER BY week_ending DESC) AS age FROM lw)
SELECT loc_name, count(*) AS n_weeks, min(week_ending) AS first_week, max(week_ending) AS last_week, string_agg(guests::VARCHAR, ',' ORDER BY week_ending) AS guests,
  '0,0,' || string_agg(guests::VARCHAR, ',' ORDER BY week_ending) FILTER (age <= 3) AS guests_padded FROM r WHERE age <= {WEEKS} GROUP BY 1""",
    "history_merge_monthly_weekly": f"""WITH {facts.MONTHS_SQL}, e AS (SELECT strftime((max(year_month) || '-01')::DATE - INTERVAL 1 MONTH, '%Y-%m') AS edge FROM lw),
b AS (SELECT loc_name, 'week' AS grain, week_ending AS point, guests, service, product FROM lw, e WHERE year_month >= edge
  UNION ALL SELECT loc_name, 'month', last_day((year_month || '-01')::DATE), guests, service, product FROM lm, e WHERE year_month < edge)
SELECT loc_name, grain, point, row_number() OVER (PARTITION BY loc_name ORDER BY grain DESC, point DESC)::BIGINT AS age, guests::BIGINT AS guests, service::DOUBLE AS service, product::DOUBLE AS product FROM b QUALIFY age <= {WEEKS}""",
    "roster_full_outer_merge": f"""WITH {facts.STYLISTS_SQL}, t AS (SELECT DISTINCT year_month FROM sw ORDER BY 1 DESC LIMIT 2),
n AS (SELECT stylist_name, loc_name, sum(guests) AS g FROM sw WHERE year_month = (SELECT max(year_month) FROM t) GROUP BY ALL), o AS (SELECT stylist_name, loc_name, sum(guests) AS g FROM sw WHERE year_month = (SELECT min(year_month) FROM t) GROUP BY ALL)
SELECT stylist_name, loc_name, coalesce(n.g, 0)::BIGINT AS now, coalesce(o.g, 0)::BIGINT AS before, n.g IS NULL AS only_before FROM n FULL JOIN o USING (stylist_name, loc_name)""",
    "monthly_trend_max": f"WITH {facts.MONTHS_SQL} SELECT loc_name, year_month, strftime((year_month || '-01')::DATE, '%b %Y') AS label, (service + product)::DOUBLE AS total_sales FROM lm WHERE service + product > 0",
    "yoy_compare": f"""WITH {facts.MONTHS_SQL}, m AS (SELECT loc_name, year_month, (service + product)::DOUBLE AS total_sales FROM lm)
SELECT a.loc_name, a.year_month, a.total_sales, b.total_sales AS prior_year, (a.total_sales::DECIMAL(18,2) - b.total_sales::DECIMAL(18,2))::DOUBLE / nullif(b.total_sales, 0) AS yoy_pct
FROM m a LEFT JOIN m b ON a.loc_name = b.loc_name AND b.year_month = (substr(a.year_month, 1, 4)::INT - 1)::VARCHAR || substr(a.year_month, 5, 3)""",
    "baseline_last_n_periods": f"""WITH {facts.WEEKS_SQL}, t AS (SELECT DISTINCT week_ending FROM lw ORDER BY 1 DESC LIMIT 4)
SELECT loc_name, count(*) AS n_weeks, sum(service + product)::DOUBLE / count(*) AS avg_total_sales, sum(guests)::DOUBLE / count(*) AS avg_guests, sum(wax_count)::DOUBLE / count(*) AS avg_wax_count, sum(treat_count)::DOUBLE / count(*) AS avg_treat_count FROM lw WHERE week_ending IN (FROM t) GROUP BY 1""",
    "unpivot_yoy": f"WITH {facts.MONTHS_SQL} SELECT loc_name, substr(year_month, 6, 2) AS month, substr(year_month, 1, 4) AS year, (service + product)::DOUBLE AS total_sales FROM lm",
    "pivot_weeks": f"""WITH {facts.WEEKS_SQL}, i AS (SELECT *, dense_rank() OVER (PARTITION BY year_month ORDER BY week_ending) AS k FROM lw)
SELECT loc_name, year_month, """ + ", ".join(f"(sum(service + product) FILTER (k = {i}))::DOUBLE AS week_{i}" for i in range(1, 7)) + " FROM i GROUP BY 1, 2",
}
