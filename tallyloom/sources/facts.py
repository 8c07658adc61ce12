"""The two grains of the library, location and stylist by week, taken from the order tables.

A location is a nation, a stylist a supplier, a manager a region; PROMO parts are products and other parts services. Weeks end on Sundays
and are cut off at the end of their month, so a week belongs to one month. Money is decimal with two places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.tables import parquet
from tallyloom.sources.work import tasks

#: Orders, each with its few lines, that go to a task where they are dealt by person.
ORDERS = 30_000
#: Lines whose figures go to a task where they are dealt by text.
LINES = 120_000
MONEY = "decimal(18,2)"
ADDITIVE = ["guests", "service", "product", "prod_hours", "wax_count", "wax", "color", "treat_count", "treat"]
LOCATION = ["loc_name", "platform", "manager"]
STYLIST = ["stylist_name", *LOCATION]


def week_ending(day: Column) -> Column:
    return F.least(F.next_day(F.date_sub(day, 1), "SU"), F.last_day(day))


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with their nation and region."""
    t = lambda n: parquet(spark, folder, n)
    rows = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    platform = F.when(F.col("n_nationkey") % 4 == 0, "salon_ultimate").otherwise("zenoti")
    return rows.select("s_suppkey", F.col("s_name").alias("stylist_name"), F.col("n_name").alias("loc_name"), F.col("n_nationkey").alias("loc_id"), F.col("r_name").alias("manager"), platform.alias("platform"))


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row a sold line, with its money, hours, week and kind."""
    li, part = parquet(spark, folder, "lineitem"), parquet(spark, folder, "part")
    rows = li.join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))  # while rows have no names
    rows = rows.join(places(spark, folder).hint("shuffle_hash"), F.col("l_suppkey") == F.col("s_suppkey"))  # nothing to sort, and a stylist's lines come together
    day = F.col("l_shipdate").cast("date")
    net = (F.col("l_extendedprice").cast(MONEY) * (F.lit(1) - F.col("l_discount").cast(MONEY))).cast(MONEY)
    return rows.select("l_orderkey", *STYLIST, "loc_id", "p_type", "l_returnflag", day.alias("day"), week_ending(day).alias("week_ending"), net.alias("net"), F.col("l_quantity").cast(MONEY).alias("hours"))


def _sum(c: Column) -> Column:
    """The sum of MONEY as a whole number of hundredths: a long in each group's row, where a decimal's sum takes four times that."""
    hundredths = F.sum((c * 100).cast("long")).cast("decimal(20,0)")
    return (hundredths * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(28,2)")


def totals(rows: DataFrame, keys: list[str], net: str = "net") -> DataFrame:
    """Additive figures of lines by keys."""
    money = lambda kind: _sum(F.when(kind, F.col(net)).otherwise(F.lit(0).cast(MONEY)))
    is_ = lambda *k: F.col("p_type").isin(*k)
    return rows.groupBy(*keys).agg(
        F.count("*").alias("guests"), money(~is_("PROMO")).alias("service"), money(is_("PROMO")).alias("product"), _sum(F.col("hours")).alias("prod_hours"),
        F.count_if(is_("SMALL")).alias("wax_count"), money(is_("SMALL")).alias("wax"), money(is_("LARGE")).alias("color"), F.count_if(is_("MEDIUM")).alias("treat_count"), money(is_("MEDIUM")).alias("treat"),
    )


def location_weeks(spark: SparkSession, folder: str) -> DataFrame:
    return totals(lines(spark, folder), [*LOCATION, "week_ending"]).withColumn("year_month", year_month(F.col("week_ending")))


def stylist_weeks(spark: SparkSession, folder: str) -> DataFrame:
    return totals(lines(spark, folder), [*STYLIST, "week_ending"]).withColumn("year_month", year_month(F.col("week_ending")))


def location_months(spark: SparkSession, folder: str) -> DataFrame:
    return totals(lines(spark, folder).withColumn("year_month", year_month(F.col("week_ending"))), [*LOCATION, "year_month"])


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """One row an order: who came, when, where (the least supplier's nation), and what it was worth. A person's rows come together."""
    li = parquet(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("s_suppkey"), F.count("*").alias("n_lines"))
    orders = parquet(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("person"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").cast(MONEY).alias("revenue"))
    rows = orders.join(li, F.col("o_orderkey") == F.col("l_orderkey")).join(places(spark, folder).select("s_suppkey", "loc_name"), "s_suppkey")
    return rows.select(F.col("o_orderkey").alias("visit"), "person", "day", "loc_name", "revenue", "n_lines").repartition(tasks(orders, ORDERS), "person")


# The same tables for DuckDB, as the heads of WITH clauses.
LINES_SQL = """places AS (
  SELECT s_suppkey, s_name AS stylist_name, n_name AS loc_name, n_nationkey AS loc_id, r_name AS manager,
    CASE WHEN n_nationkey % 4 = 0 THEN 'salon_ultimate' ELSE 'zenoti' END AS platform
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
lines AS (
  SELECT l_orderkey, stylist_name, loc_name, loc_id, manager, platform, p_type, l_returnflag, l_shipdate::DATE AS day,
    least(l_shipdate::DATE + (7 - isodow(l_shipdate::DATE))::INT, last_day(l_shipdate::DATE)) AS week_ending,
    (l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(18,2)))::DECIMAL(18,2) AS net, l_quantity::DECIMAL(18,2) AS hours
  FROM lineitem JOIN places ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""


def totals_sql(keys: str, rows: str = "lines", net: str = "net") -> str:
    money = lambda c: f"sum(CASE WHEN {c} THEN {net} ELSE 0 END)"
    return f"""SELECT {keys}, count(*) AS guests, {money("p_type <> 'PROMO'")} AS service, {money("p_type = 'PROMO'")} AS product, sum(hours) AS prod_hours,
  count(*) FILTER (p_type = 'SMALL') AS wax_count, {money("p_type = 'SMALL'")} AS wax, {money("p_type = 'LARGE'")} AS color,
  count(*) FILTER (p_type = 'MEDIUM') AS treat_count, {money("p_type = 'MEDIUM'")} AS treat FROM {rows} GROUP BY {keys}"""


WEEKS_SQL = f"{LINES_SQL},\nlw AS (SELECT *, strftime(week_ending, '%Y-%m') AS year_month FROM ({totals_sql('loc_name, platform, manager, week_ending')}))"
STYLISTS_SQL = f"{LINES_SQL},\nsw AS (SELECT *, strftime(week_ending, '%Y-%m') AS year_month FROM ({totals_sql('stylist_name, loc_name, platform, manager, week_ending')}))"
MONTHS_SQL = f"{WEEKS_SQL},\nlm AS (SELECT loc_name, platform, manager, year_month, sum(guests) AS guests, sum(service) AS service, sum(product) AS product, sum(prod_hours) AS prod_hours, sum(wax_count) AS wax_count, sum(wax) AS wax, sum(color) AS color, sum(treat_count) AS treat_count, sum(treat) AS treat FROM lw GROUP BY ALL)"
VISITS_SQL = f"""{LINES_SQL},
visits AS (
  SELECT o_orderkey AS visit, o_custkey AS person, o_orderdate::DATE AS day, loc_name, o_totalprice::DECIMAL(18,2) AS revenue, n_lines
  FROM orders JOIN (SELECT l_orderkey, min(l_suppkey) AS k, count(*) AS n_lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey JOIN places ON s_suppkey = k)"""
