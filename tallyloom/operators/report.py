"""Weekly report, goals, leaderboards and totals. A totals row shows sums, and ratios of sums beside sums of ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import calendar, kpi
from tallyloom.operators.cumulative import month_to_date, week_in_month
from tallyloom.sources import facts
from tallyloom.sources.work import stored, work_folder
from tallyloom.sources.facts import ADDITIVE

WEEK = "week_ending"
#: Months whose working days aren't those of the calendar.
OVERRIDES = (("1997-05", 25), ("1998-12", 26))
GOAL_GROWTH = "1.05"


def _latest(spark, sf_dir) -> DataFrame:
    """Month-to-date snapshots of every location with their week of the month."""
    return week_in_month(kpi.with_ratios(month_to_date(facts.location_weeks(spark, sf_dir), ["loc_name"])))


def with_totals(df: DataFrame, within: list[str], label: str, sums: list[str], ratios=kpi.LOCATION_RATIOS) -> DataFrame:
    """df's rows and a TOTALS row for each of `within`, in one pass: ratios there are of sums, and sum_<ratio> adds up the rows' own."""
    rolled = df.select(*within, F.explode(F.array(F.col(label), F.lit("TOTALS"))).alias(label), *sums, *(n for n, *_ in ratios))
    rows = rolled.groupBy(*within, label).agg(F.count("*").alias("n_rows"), *(F.sum(c).alias(c) for c in sums), *(F.sum(F.col(n).cast("decimal(38,9)")).cast("decimal(38,4)").alias(f"sum_{n}") for n, *_ in ratios))
    return kpi.with_ratios(rows, ratios)


def report_week_kpi_block(spark, sf_dir):
    """Each week's block: every location of the roster, blank where it has no snapshot that week, with the projection of its month."""
    snaps = calendar.projected(_latest(spark, sf_dir), "total_sales", spark.createDataFrame(list(OVERRIDES), "year_month string, days long"))
    snaps = stored(snaps, work_folder(spark))
    weeks = snaps.agg(F.collect_set(F.struct("year_month", WEEK, "week_idx"))).scalar()  # one a calendar week, however many locations there are
    places = snaps.select("loc_name").distinct().select("loc_name", F.inline(weeks))
    out = places.join(snaps.drop("week_idx"), ["loc_name", "year_month", WEEK], "left").withColumn("present", F.col("guests").isNotNull())
    return kpi.plain(out, ["loc_name", "year_month", WEEK, "week_idx", "present", *kpi.FIGURES, "avg_ticket", "days_elapsed", "days_in_month", "projection"])


def report_totals_rollup(spark, sf_dir):
    out = with_totals(kpi.with_ratios(facts.location_weeks(spark, sf_dir)), [WEEK], "loc_name", ADDITIVE)
    return kpi.plain(out, ["loc_name", WEEK, "n_rows", *kpi.FIGURES, "product_pct", "ppg", "pph", "avg_ticket", "sum_ppg", "sum_pph", "sum_avg_ticket"])


def report_service_mix(spark, sf_dir):
    """Each location's and month's service mix, with the network's as TOTALS."""
    out = with_totals(kpi.with_ratios(facts.location_months(spark, sf_dir)), ["year_month"], "loc_name", ADDITIVE)
    return kpi.plain(out, ["loc_name", "year_month", "guests", "wax_count", "wax", "wax_pct", "color", "color_pct", "treat_count", "treat", "treat_pct"])


def projection_working_days(spark, sf_dir):
    out = calendar.projected(_latest(spark, sf_dir), "total_sales", spark.createDataFrame(list(OVERRIDES), "year_month string, days long"))
    return kpi.plain(out, ["loc_name", "year_month", WEEK, "total_sales", "days_elapsed", "days_in_month", "projection"])


def goal_pacing(spark, sf_dir):
    """Month-to-date against goals: the goal of a month is GOAL_GROWTH times the same month a year before, spread over working days."""
    snaps = calendar.projected(_latest(spark, sf_dir), "total_sales")
    months = kpi.with_ratios(facts.location_months(spark, sf_dir))
    goals = months.select("loc_name", F.concat((F.substring("year_month", 1, 4).cast("int") + 1).cast("string"), F.substring("year_month", 5, 3)).alias("year_month"), (F.col("total_sales") * F.lit(GOAL_GROWTH).cast("decimal(4,2)")).cast("decimal(18,2)").alias("goal"))
    out = snaps.join(goals, ["loc_name", "year_month"], "left")
    day_goal = F.col("goal").cast("double") * F.col("days_elapsed") / F.col("days_in_month")
    out = out.withColumn("day_goal", day_goal).withColumn("goal_pct", F.try_divide(F.col("total_sales").cast("double"), F.col("day_goal")))
    status = F.when(F.col("goal").isNull(), "no goal").when(F.col("goal_pct") >= 1, "ahead").when(F.col("goal_pct") >= 0.9, "near").otherwise("behind")
    return kpi.plain(out.withColumn("status", status), ["loc_name", "year_month", WEEK, "total_sales", "goal", "day_goal", "goal_pct", "status"])


def leaderboard_with_prior(spark, sf_dir):
    """Places by sales in each week, the place in the location's week before, and the trend in percent (0 without a prior)."""
    rows = kpi.with_ratios(facts.location_weeks(spark, sf_dir))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(WEEK).orderBy(F.col("total_sales").desc(), "loc_name")))
    w = Window.partitionBy("loc_name").orderBy(WEEK)
    rows = rows.withColumns({"prior_place": F.lag("place").over(w), "prior_sales": F.lag("total_sales").over(w)})
    trend = F.coalesce(F.try_divide((F.col("total_sales") - F.col("prior_sales")).cast("double") * 100, F.col("prior_sales").cast("double")), F.lit(0.0))
    return kpi.plain(rows.withColumn("trend_pct", trend), ["loc_name", WEEK, "place", "prior_place", "total_sales", "trend_pct"])


def dashboard_cards(spark, sf_dir):
    """Network totals a week, each against the week before."""
    rows = facts.location_weeks(spark, sf_dir).groupBy(WEEK).agg(F.count("*").alias("n_locations"), *(F.sum(c).alias(c) for c in ADDITIVE))
    rows = kpi.with_ratios(rows)
    w = Window.orderBy(WEEK)  # one row a calendar week
    near = F.datediff(WEEK, F.lag(WEEK).over(w)) <= 10
    return kpi.plain(rows.withColumn("prior_sales", F.when(near, F.lag("total_sales").over(w))), [WEEK, "n_locations", *kpi.FIGURES, "product_pct", "pph", "avg_ticket", "prior_sales"])


QUERIES = {f.__name__: f for f in (report_week_kpi_block, report_totals_rollup, report_service_mix, projection_working_days, goal_pacing, leaderboard_with_prior, dashboard_cards)}

_MTD = ", ".join(f"sum({f}) OVER w AS {f}" for f in ADDITIVE)
_SNAPS = f"""{facts.WEEKS_SQL},
mtd AS (SELECT loc_name, week_ending, year_month, {_MTD} FROM lw WINDOW w AS (PARTITION BY loc_name, year_month ORDER BY week_ending)),
snaps AS (SELECT *, service + product AS total_sales, dense_rank() OVER (PARTITION BY year_month ORDER BY week_ending) AS week_idx,
  len(list_filter(range((year_month || '-01')::DATE, week_ending + 1, INTERVAL 1 DAY), lambda d: isodow(d) < 7)) AS days_elapsed,
  len(list_filter(range((year_month || '-01')::DATE, last_day(week_ending) + 1, INTERVAL 1 DAY), lambda d: isodow(d) < 7)) AS days_in_calendar FROM mtd),
proj AS (SELECT * REPLACE (week_idx::BIGINT AS week_idx), CASE year_month {' '.join(f"WHEN '{m}' THEN {d}" for m, d in OVERRIDES)} ELSE days_in_calendar END::BIGINT AS days_in_month FROM snaps)"""
_P = "total_sales::DOUBLE / nullif(days_elapsed::DOUBLE, 0) * days_in_month AS projection"
_SUMS = ", ".join(f"sum({c}) AS {c}" for c in ADDITIVE)


def _rolled(keys: str, source: str) -> str:
    ratios = ", ".join(f"sum({n}::DECIMAL(38,9))::DECIMAL(38,4) AS sum_{n}" for n in kpi.ALL_RATIOS)
    return f"""k AS (SELECT *, {kpi.ratios_sql()} FROM {source}),
t AS (SELECT loc_name, {keys}, count(*) AS n_rows, {_SUMS}, {ratios} FROM k GROUP BY ALL UNION ALL BY NAME SELECT 'TOTALS' AS loc_name, {keys}, count(*) AS n_rows, {_SUMS}, {ratios} FROM k GROUP BY ALL)"""


ORACLE = {
    "report_week_kpi_block": f"""WITH {_SNAPS}, d AS (SELECT * FROM (SELECT DISTINCT year_month, week_ending, week_idx FROM proj), (SELECT DISTINCT loc_name FROM proj))
SELECT loc_name, year_month, week_ending, d.week_idx::BIGINT AS week_idx, p.guests IS NOT NULL AS present, {kpi.MONEY_SQL}, {kpi.ratios_sql((kpi.LOCATION_RATIOS[3],)).replace('coalesce(', 'CASE WHEN guests IS NOT NULL THEN coalesce(').replace(', 0.0)', ', 0.0) END')}, days_elapsed, days_in_month, {_P} FROM d LEFT JOIN proj p USING (loc_name, year_month, week_ending)""",
    "report_totals_rollup": f"WITH {facts.WEEKS_SQL}, {_rolled('week_ending', 'lw')} SELECT loc_name, week_ending, n_rows, {kpi.MONEY_SQL}, {kpi.ratios_sql(kpi.LOCATION_RATIOS[:4])}, sum_ppg::DOUBLE AS sum_ppg, sum_pph::DOUBLE AS sum_pph, sum_avg_ticket::DOUBLE AS sum_avg_ticket FROM t",
    "report_service_mix": f"WITH {facts.MONTHS_SQL}, {_rolled('year_month', 'lm')} SELECT loc_name, year_month, guests::BIGINT AS guests, wax_count::BIGINT AS wax_count, wax::DOUBLE AS wax, color::DOUBLE AS color, treat_count::BIGINT AS treat_count, treat::DOUBLE AS treat, {kpi.ratios_sql(kpi.LOCATION_RATIOS[4:])} FROM t",
    "projection_working_days": f"WITH {_SNAPS} SELECT loc_name, year_month, week_ending, total_sales::DOUBLE AS total_sales, days_elapsed, days_in_month, {_P} FROM proj",
    "goal_pacing": f"""WITH {_SNAPS}, g AS (SELECT loc_name, (substr(year_month, 1, 4)::INT + 1)::VARCHAR || substr(year_month, 5, 3) AS year_month, (sum(service + product) * {GOAL_GROWTH}::DECIMAL(4,2))::DECIMAL(18,2) AS goal FROM lw GROUP BY 1, 2),
x AS (SELECT s.*, goal::DOUBLE AS goal, goal::DOUBLE * days_elapsed / days_in_calendar AS day_goal FROM snaps s LEFT JOIN g USING (loc_name, year_month))
SELECT loc_name, year_month, week_ending, total_sales::DOUBLE AS total_sales, goal, day_goal, total_sales::DOUBLE / nullif(day_goal, 0) AS goal_pct,
  CASE WHEN goal IS NULL THEN 'no goal' WHEN goal_pct >= 1 THEN 'ahead' WHEN goal_pct >= 0.9::DOUBLE THEN 'near' ELSE 'behind' END AS status FROM x""",
    "leaderboard_with_prior": f"""WITH {facts.WEEKS_SQL}, p AS (SELECT loc_name, week_ending, service + product AS total_sales, row_number() OVER (PARTITION BY week_ending ORDER BY service + product DESC, loc_name)::BIGINT AS place FROM lw),
q AS (SELECT *, lag(place) OVER w AS prior_place, lag(total_sales) OVER w AS prior_sales FROM p WINDOW w AS (PARTITION BY loc_name ORDER BY week_ending))
SELECT loc_name, week_ending, place, prior_place, total_sales::DOUBLE AS total_sales, coalesce((total_sales - prior_sales)::DOUBLE * 100 / nullif(prior_sales::DOUBLE, 0), 0.0) AS trend_pct FROM q""",
    "dashboard_cards": f"""WITH {facts.WEEKS_SQL}, t AS (SELECT week_ending, count(*) AS n_locations, {_SUMS} FROM lw GROUP BY 1)
SELECT week_ending, n_locations, {kpi.MONEY_SQL}, {kpi.ratios_sql((kpi.LOCATION_RATIOS[0], *kpi.LOCATION_RATIOS[2:4]))}, (SELECT arg_max(u.service + u.product, u.week_ending)::DOUBLE FROM t u WHERE u.week_ending BETWEEN t.week_ending - 10 AND t.week_ending - 1) AS prior_sales FROM t""",
}
