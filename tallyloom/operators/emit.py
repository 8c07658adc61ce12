"""What reports and dashboards are fed with: histories as arrays, payloads of a location and of a territory, briefs, and merged sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import kpi
from tallyloom.operators.history import WEEKS, last_n, pad_left
from tallyloom.sources import facts

WEEK = "week_ending"


def arrays(df: DataFrame, keys: list[str], order: str, columns: dict[str, Column]) -> DataFrame:
    """One row an entity with each column as an array, oldest first."""
    out = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("_o"), *(c.alias(n) for n, c in columns.items())))).alias("_x"))
    values = lambda n: F.transform("_x", lambda x: x[n]).alias(n)
    return out.select(*keys, *(values(n) for n in columns))


def text_of(array: str, digits: int, n: int = WEEKS) -> Column:
    """The last n values with so many digits, zeros before them up to n, as text."""
    x = F.slice(array, F.greatest(F.lit(1), F.size(array) - n + 1), F.lit(n))
    return F.array_join(F.transform(pad_left(x, n), lambda v: F.floor(v * 10**digits + 0.5).cast("long").cast("string")), ",")


def replace_tail(array: Column, value: Column) -> Column:
    """array with its last element replaced, or left out where the value is null: a placeholder without a figure."""
    head = F.slice(array, F.lit(1), F.greatest(F.lit(0), F.size(array) - 1))
    return F.when(F.size(array) == 0, array).when(value.isNull(), head).otherwise(F.concat(head, F.array(value)))


def merge_sources(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """left with the columns of right where location and both dates are equal, and whether there was such a row; left's rows stay as they are.
    Of several rows of right with equal keys the least, column by column in order, counts."""
    r = right.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_r")).select(*keys, *(F.col(f"_r.{c}").alias(f"other_{c}") for c in columns), F.lit(True).alias("_in"))
    return left.join(r, keys, "left").withColumn("merged", F.coalesce("_in", F.lit(False))).drop("_in")


def keep_last_known(df: DataFrame, key: str, order: str, column: str) -> DataFrame:
    """df with null or empty values of the column replaced by the key's last one before."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn(column, F.last(F.nullif(F.col(column), F.lit("")), ignorenulls=True).over(w))


def json_rows(text: Column, schema: str) -> Column:
    """The objects of the first list in a text, from the first [ to the last ]; what is no list gives none."""
    return F.coalesce(F.from_json(F.regexp_extract(text, r"(?s)(\[.*\])", 1), f"array<{schema}>"), F.array().cast(f"array<{schema}>"))


def _weeks(spark, sf_dir) -> DataFrame:
    return kpi.with_ratios(facts.location_weeks(spark, sf_dir))


def _stylists(spark, sf_dir) -> DataFrame:
    return kpi.with_ratios(facts.stylist_weeks(spark, sf_dir), kpi.STYLIST_RATIOS)


def location_arrays(spark, sf_dir):
    """The last 12 weeks of each location: sales, productivity in cents, product share in tenths of a percent, guests; zeros before short histories."""
    d = lambda c: F.col(c).cast("double")
    a = arrays(last_n(_weeks(spark, sf_dir), ["loc_name"], WEEK, WEEKS), ["loc_name"], WEEK, {"s": d("total_sales"), "h": d("pph"), "p": d("product_pct") * 100, "g": d("guests")})
    return a.select("loc_name", text_of("s", 0).alias("sales"), text_of("h", 2).alias("pph"), text_of("p", 1).alias("product"), text_of("g", 0).alias("guests"))


def week_labels(spark, sf_dir):
    """The last 12 weeks that any location has, oldest first."""
    w = facts.location_weeks(spark, sf_dir).select(WEEK).distinct().orderBy(F.col(WEEK).desc()).limit(WEEKS)
    return w.select(WEEK, F.row_number().over(Window.orderBy(WEEK)).cast("long").alias("place"), F.date_format(WEEK, "yyyy-MM-dd").alias("label"))


def stylist_scan(spark, sf_dir):
    """Each stylist's weeks as arrays, with the attributes and figures of the latest week."""
    s = _stylists(spark, sf_dir)
    last = s.groupBy("stylist_name").agg(F.count("*").alias("n_weeks"), F.max_by(F.struct("loc_name", "platform", "pph", "avg_ticket"), WEEK).alias("l"))
    a = arrays(s, ["stylist_name"], WEEK, {"h": F.col("pph"), "g": F.col("guests").cast("double")})
    return a.join(last, "stylist_name").select("stylist_name", "n_weeks", "l.loc_name", "l.platform", F.col("l.pph").alias("cur_pph"), F.col("l.avg_ticket").alias("cur_ticket"), text_of("h", 2).alias("pph"), text_of("g", 0).alias("services"))


def stylist_monthly_scan(spark, sf_dir):
    """Monthly rows of each stylist, their week the period's end or, where that is missing (in even months), the 28th; product share computed anew."""
    m = facts.totals(facts.lines(spark, sf_dir).withColumn("year_month", facts.year_month(F.col(WEEK))), ["stylist_name", "loc_name", "year_month"])
    first = F.to_date(F.concat("year_month", F.lit("-01")))
    end = F.when(F.month(first) % 2 == 1, F.date_format(F.last_day(first), "yyyy-MM-dd"))
    m = m.withColumn("week", F.coalesce(end, F.concat("year_month", F.lit("-28"))))
    pct = kpi.ratio(F.col("product"), F.col("service") + F.col("product")) * 100
    a = arrays(m, ["stylist_name"], "year_month", {"w": F.col("week"), "p": pct, "n": F.col("guests").cast("double")})
    return a.select("stylist_name", F.array_join("w", ",").alias("weeks"), text_of("p", 2).alias("product_pct"), text_of("n", 0).alias("services"))


def months_by_list(spark, sf_dir):
    """Monthly rows of given months; the list prunes the scan's groups."""
    m = kpi.with_ratios(facts.location_months(spark, sf_dir)).where(F.col("year_month").isin("1996-02", "1996-05", "1998-01"))
    return kpi.plain(m, ["loc_name", "year_month", "guests", "total_sales"])


def goals_by_month(spark, sf_dir):
    """Goals set several times: of a location's goals for a month the last counts. A goal is the sales of one of the month's weeks, set that day."""
    g = _weeks(spark, sf_dir).groupBy("loc_name", "year_month").agg(F.max_by(F.col("total_sales").cast("double"), WEEK).alias("goal"))
    ids = facts.places(spark, sf_dir).select("loc_name", F.col("loc_id").cast("long").alias("loc_id")).distinct()
    return ids.join(g, "loc_name", "left")


def current_scan(spark, sf_dir):
    """Rows of text with too few cells, blank keys and bad numbers, read by position and given their location's id."""
    w = facts.location_weeks(spark, sf_dir).select("loc_name", WEEK, "guests", "service")
    k = F.dayofyear(WEEK) % 7
    cells = F.when(k == 0, F.array("loc_name")).when(k == 1, F.array(F.lit("  "), F.lit("1"), F.lit("2"))).when(k == 2, F.array(F.col("loc_name"), F.lit("n/a"), F.col("service").cast("string"))).otherwise(F.array(F.concat(F.lit(" "), F.col("loc_name")), F.col("guests").cast("string"), F.col("service").cast("string")))
    rows = w.select(WEEK, F.trim(F.get(cells, F.lit(0))).alias("loc_name"), F.coalesce(F.get(cells, F.lit(1)).try_cast("long"), F.lit(0)).alias("guests"), F.coalesce(F.get(cells, F.lit(2)).try_cast("double"), F.lit(0.0)).alias("service")).where("loc_name <> ''")
    ids = facts.places(spark, sf_dir).select("loc_name", F.col("loc_id").cast("long").alias("loc_id")).distinct()
    return rows.join(ids, "loc_name", "left")


def dict_scan(spark, sf_dir):
    """Rows by header: names zipped with values, missing ones empty."""
    p = facts.places(spark, sf_dir)
    header = F.array(F.lit("name"), F.lit("place"), F.lit("region"))
    values = F.when(F.col("s_suppkey") % 3 == 0, F.array("stylist_name")).otherwise(F.array("stylist_name", "loc_name", "manager"))
    row = F.map_from_arrays(header, F.transform(header, lambda _, i: F.coalesce(F.get(values, i), F.lit(""))))
    return p.select("s_suppkey", row["name"].alias("name"), row["place"].alias("place"), row["region"].alias("region"))


def data_block(spark, sf_dir):
    """What a page embeds: one JSON object a location with its last weeks' guests and labels."""
    a = arrays(last_n(facts.location_weeks(spark, sf_dir), ["loc_name", "platform"], WEEK, WEEKS), ["loc_name", "platform"], WEEK, {"g": F.col("guests").cast("long"), "w": F.date_format(WEEK, "yyyy-MM-dd")})
    return a.select("loc_name", F.to_json(F.struct(F.col("loc_name").alias("name"), F.col("platform").alias("plat"), F.col("w").alias("weeks"), F.col("g").alias("guests"))).alias("block"))


def territory_brief(spark, sf_dir):
    """A manager's week: locations, the best and the last by service an hour, and how far the best is from the network's mean."""
    w = _weeks(spark, sf_dir)
    net = w.where("pph > 0").groupBy(WEEK).agg(kpi.mean(F.col("pph")).alias("net_pph"))
    t = w.groupBy("manager", WEEK).agg(F.count("*").alias("n_locations"), F.min_by(F.struct("loc_name", "pph"), F.struct(-F.col("pph"), "loc_name")).alias("top"), F.min_by(F.struct("loc_name", "pph"), F.struct("pph", "loc_name")).alias("low"))
    return t.join(net, WEEK, "left").select("manager", WEEK, "n_locations", F.col("top.loc_name").alias("top_location"), F.col("top.pph").alias("top_pph"), F.col("low.loc_name").alias("low_location"), F.col("low.pph").alias("low_pph"), (F.col("top.pph") - F.col("net_pph")).alias("lead"))


def brief_rows(spark, sf_dir):
    """A brief a manager and week; in weeks without one, every third, the one before stays."""
    w = facts.location_weeks(spark, sf_dir).groupBy("manager", WEEK).agg(F.sum("guests").alias("guests"))
    text = F.when(F.weekofyear(WEEK) % 3 != 0, F.concat(F.lit("guests: "), F.col("guests"))).otherwise("")
    return keep_last_known(w.select("manager", WEEK, text.alias("brief")), "manager", WEEK, "brief")


def network_payload(spark, sf_dir):
    """Largest and least positive productivity of each week, and the mean of positive tickets."""
    pos = F.when(F.col("pph") > 0, F.col("pph"))
    return _weeks(spark, sf_dir).groupBy(WEEK).agg(F.coalesce(F.max(pos), F.lit(0.0)).alias("top_pph"), F.coalesce(F.min(pos), F.lit(0.0)).alias("bottom_pph"), kpi.mean(F.when(F.col("avg_ticket") > 0, F.col("avg_ticket"))).alias("avg_ticket"), F.count("*").alias("n_locations"))


def location_payload(spark, sf_dir):
    """A location's week: the mean of its last three productivities, its best stylist, the first below the watch line, and how many it has."""
    last3 = Window.partitionBy("loc_name").orderBy(WEEK).rowsBetween(-2, 0)
    w = _weeks(spark, sf_dir).select("loc_name", WEEK, "pph", (F.sum(kpi.millionths(F.col("pph"))).over(last3).cast("double") / 1e6 / F.count("*").over(last3)).alias("pph_3wk"))
    s = _stylists(spark, sf_dir)
    order = F.struct(-F.col("pph"), "stylist_name")
    low = F.col("pph") < 1000
    t = s.groupBy("loc_name", WEEK).agg(F.count("*").alias("n_stylists"), F.min_by("stylist_name", order).alias("top_stylist"), F.min(F.when(low, F.struct((-F.col("pph")).alias("o"), F.col("stylist_name").alias("n"))))["n"].alias("watch_stylist"), kpi.mean(F.when(F.col("avg_ticket") > 0, F.col("avg_ticket"))).alias("avg_ticket"))
    return w.join(t, ["loc_name", WEEK])


def live_and_historical(spark, sf_dir):
    """Stylists of the last week with the change against their week before, and the others with their last week: one table, told apart."""
    s = facts.stylist_weeks(spark, sf_dir).select("stylist_name", WEEK, "guests")
    end = s.agg(F.max(WEEK)).scalar()
    w = Window.partitionBy("stylist_name").orderBy(F.col(WEEK).desc())
    s = s.withColumns({"n": F.row_number().over(w), "before": F.lead("guests").over(w)}).where("n = 1")
    live = s.where(F.col(WEEK) == end).select("stylist_name", WEEK, (F.col("guests") - F.coalesce("before", F.lit(0))).cast("long").alias("change"), F.lit("live").alias("kind"))
    return live.unionByName(s.where(F.col(WEEK) != end).select("stylist_name", WEEK, F.lit(None).cast("long").alias("change"), F.lit("historical").alias("kind")))


def replaced_tails(spark, sf_dir):
    """Guests of each stylist with the last one replaced by its change; where that is negative the placeholder is dropped."""
    s = facts.stylist_weeks(spark, sf_dir)
    a = arrays(s, ["stylist_name"], WEEK, {"g": F.col("guests").cast("long")})
    change = F.try_element_at("g", F.lit(-1)) - F.coalesce(F.try_element_at("g", F.lit(-2)), F.lit(0))
    return a.select("stylist_name", F.array_join(F.transform(replace_tail(F.col("g"), F.when(change >= 0, change)), lambda x: x.cast("string")), ",").alias("guests"))


def rounded_deltas(spark, sf_dir):
    """Differences to two digits and relative ones to a tenth of a percent; null without a week before or where that is 0."""
    w = Window.partitionBy("loc_name").orderBy(WEEK)
    x = _weeks(spark, sf_dir).select("loc_name", WEEK, F.col("total_sales").cast("double").alias("now"), F.lag(F.col("total_sales").cast("double")).over(w).alias("before"))
    return x.select("loc_name", WEEK, kpi.rounded(F.col("now") - F.col("before"), 2).alias("delta"), kpi.rounded(F.try_divide(F.col("now") - F.col("before"), F.abs("before")) * 100, 1).alias("delta_pct"))


def recognition_alerts(spark, sf_dir):
    """Alerts of a week: recognition of the best location, a watch on the last, drops of productivity, and a briefing for all."""
    w = _weeks(spark, sf_dir)
    o = Window.partitionBy(WEEK)
    w = w.withColumns({"top": F.row_number().over(o.orderBy(F.col("pph").desc(), "loc_name")), "low": F.row_number().over(o.orderBy("pph", F.col("loc_name").desc())), "before": F.lag("pph").over(Window.partitionBy("loc_name").orderBy(WEEK)), "n": F.count("*").over(o)})
    row = lambda on, kind, severity: F.when(on, F.struct(F.lit(kind).alias("kind"), F.lit(severity).alias("severity")))
    change = F.try_divide(F.col("pph") - F.col("before"), F.abs("before")) * 100
    rows = F.array_compact(F.array(row(F.col("top") == 1, "RECOGNITION", "LOW"), row((F.col("low") == 1) & (F.col("n") > 1), "WATCH", "HIGH"), row(change <= -5, "PPH_DROP", "MEDIUM")))
    brief = w.select(WEEK).distinct().select(F.lit("ALL LOCATIONS").alias("loc_name"), WEEK, F.lit("COACH BRIEFING").alias("kind"), F.lit("LOW").alias("severity"))
    return w.select("loc_name", WEEK, F.inline(rows)).unionByName(brief)


def with_prior_year(months: DataFrame, key: str, value: str) -> DataFrame:
    """(key, year_month, now, prior_year) of months(key, year_month, value): a key is in a month that the table has if it has it or had it the year before."""
    after = F.date_format(F.add_months(F.to_date("year_month", "yyyy-MM"), 12), "yyyy-MM")
    now, prior = months.select(key, "year_month", F.col(value).alias("now")), months.select(key, after.alias("year_month"), F.col(value).alias("prior_year"))
    return now.join(prior, [key, "year_month"], "full").join(months.select("year_month").distinct(), "year_month", "left_semi")


def yoy_totals(spark, sf_dir):
    """Every month's locations with goals and the year before, and its totals: the goal share of the totals is of sums, not a mean."""
    m = kpi.with_ratios(facts.location_months(spark, sf_dir)).select("loc_name", "year_month", "total_sales")
    t = with_prior_year(m, "loc_name", "total_sales")
    t = t.withColumn("goal", F.when(~F.col("loc_name").like("%5"), (F.col("prior_year") * F.lit("1.10").cast("decimal(4,2)")).cast(facts.MONEY)))
    zero = F.lit(0).cast(facts.MONEY)
    total = t.groupBy("year_month").agg(F.lit("TOTALS").alias("loc_name"), F.sum("now").alias("now"), F.sum(F.when(F.col("goal").isNotNull(), F.coalesce("now", zero))).alias("with_goal"), F.sum("goal").alias("goal"), F.sum("prior_year").alias("prior_year"))
    out = kpi.plain(t.withColumn("with_goal", F.coalesce("now", zero)).select(total.columns).unionByName(total), total.columns)
    goal_pct, yoy_pct = kpi.ratio(F.col("with_goal"), F.col("goal"), kpi.NULL), kpi.ratio(F.col("now") - F.col("prior_year"), F.col("prior_year"), kpi.NULL)
    return out.select("loc_name", "year_month", "now", "goal", "prior_year", goal_pct.alias("goal_pct"), yoy_pct.alias("yoy_pct"))


def merged_sources(spark, sf_dir):
    """Weekly sheets with the report of the same location and dates; reports lack every fifth week and some start a day late."""
    w = facts.location_weeks(spark, sf_dir).select("loc_name", F.date_sub(WEEK, 6).alias("period_start"), F.col(WEEK).alias("period_end"), "guests", "service")
    k = F.weekofyear("period_end") % 5
    r = w.where(k != 0).select("loc_name", F.when(k == 1, F.date_add("period_start", 1)).otherwise(F.col("period_start")).alias("period_start"), "period_end", F.col("service").cast("double").alias("service"))
    return merge_sources(w.drop("service"), r, ["loc_name", "period_start", "period_end"], ["service"]).withColumn("guests", F.col("guests").cast("long"))


def flattened(spark, sf_dir):
    """Locations with nested stylists, one row a stylist again."""
    s = facts.stylist_weeks(spark, sf_dir).groupBy("loc_name", WEEK).agg(F.collect_list(F.struct("stylist_name", F.col("guests").cast("long").alias("guests"))).alias("stylists"))
    return s.select("loc_name", WEEK, F.inline("stylists"))


def drift_by_location(spark, sf_dir):
    """Location-weeks against their own location's thresholds, mean productivity of its weeks by half and by two; others have none and are left out."""
    w = _weeks(spark, sf_dir)
    t = w.where("NOT loc_name LIKE '%2'").groupBy("loc_name").agg(kpi.mean(F.col("pph")).alias("m")).select("loc_name", (F.col("m") / 2).alias("least"), (F.col("m") * 2).alias("most"))
    return w.join(t, "loc_name").where(~F.col("pph").between(F.col("least"), F.col("most"))).select("loc_name", WEEK, "pph", F.when(F.col("pph") < F.col("least"), "low").otherwise("high").alias("drift"))


def categorised(spark, sf_dir):
    """Orders with the category that a reply in prose and JSON gives them; those it leaves out get the defaults."""
    from tallyloom.sources.tables import parquet

    o = parquet(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    reply = o.where("o_orderkey % 3 <> 0").groupBy("o_custkey").agg(F.concat(F.lit("Sure! "), F.to_json(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, "urgent").otherwise("later").alias("category")))), F.lit(" Done.")).alias("text"))
    found = reply.select(F.inline(json_rows(F.col("text"), "struct<id:bigint,category:string>")))
    return o.join(found, F.col("o_orderkey") == F.col("id"), "left").select("o_orderkey", F.coalesce("category", F.lit("uncategorised")).alias("category"))


QUERIES = {
    f.__name__: f
    for f in (
        location_arrays, week_labels, stylist_scan, stylist_monthly_scan, months_by_list, goals_by_month, current_scan, dict_scan, data_block, territory_brief, brief_rows, network_payload, location_payload,
        live_and_historical, replaced_tails, rounded_deltas, recognition_alerts, yoy_totals, merged_sources, flattened, drift_by_location, categorised,
    )
}

_LK = f"{facts.WEEKS_SQL}, lk AS (SELECT *, service + product AS total_sales, {kpi.ratios_sql()} FROM lw)"
_SK = f"{facts.STYLISTS_SQL}, sk AS (SELECT *, service + product AS total_sales, {kpi.ratios_sql(kpi.STYLIST_RATIOS)} FROM sw)"
_MK = f"{facts.MONTHS_SQL}, mk AS (SELECT *, service + product AS total_sales FROM lm)"


def _txt(x: str, digits: int, order: str, last: bool = False) -> str:
    """The last 12 values as whole numbers, zeros before them."""
    values = f"list(({x})::DOUBLE ORDER BY {order})"
    tail = f"{values}[-{WEEKS}:]"
    return f"array_to_string(list_transform(list_concat(list_transform(range(greatest(0, {WEEKS} - count(*))::BIGINT), lambda i: 0.0::DOUBLE), {tail}), lambda v: floor(v * {10**digits} + 0.5::DOUBLE)::BIGINT::VARCHAR), ',')"


ORACLE = {
    "location_arrays": f"""WITH {_LK} SELECT loc_name, {_txt("total_sales", 0, "week_ending")} AS sales, {_txt("pph", 2, "week_ending")} AS pph, {_txt("product_pct * 100", 1, "week_ending")} AS product, {_txt("guests", 0, "week_ending")} AS guests FROM lk GROUP BY 1""",
    "week_labels": f"""WITH {facts.WEEKS_SQL}, w AS (SELECT DISTINCT week_ending FROM lw ORDER BY 1 DESC LIMIT {WEEKS}) SELECT week_ending, row_number() OVER (ORDER BY week_ending) AS place, week_ending::VARCHAR AS label FROM w""",
    "stylist_scan": f"""WITH {_SK} SELECT stylist_name, count(*) AS n_weeks, arg_max(loc_name, week_ending) AS loc_name, arg_max(platform, week_ending) AS platform, arg_max(pph, week_ending) AS cur_pph, arg_max(avg_ticket, week_ending) AS cur_ticket,
  {_txt("pph", 2, "week_ending")} AS pph, {_txt("guests", 0, "week_ending")} AS services FROM sk GROUP BY 1""",
    "stylist_monthly_scan": f"""WITH {facts.STYLISTS_SQL}, m AS (SELECT stylist_name, year_month, sum(guests) AS guests, sum(service) AS service, sum(product) AS product FROM sw GROUP BY 1, 2)
SELECT stylist_name, string_agg(CASE WHEN substr(year_month, 6)::INT % 2 = 1 THEN last_day((year_month || '-01')::DATE)::VARCHAR ELSE year_month || '-28' END, ',' ORDER BY year_month) AS weeks,
  {_txt("coalesce(product::DOUBLE / nullif((service + product)::DOUBLE, 0), 0.0) * 100", 2, "year_month")} AS product_pct, {_txt("guests", 0, "year_month")} AS services FROM m GROUP BY 1""",
    "months_by_list": f"WITH {_MK} SELECT loc_name, year_month, guests::BIGINT AS guests, total_sales::DOUBLE AS total_sales FROM mk WHERE year_month IN ('1996-02', '1996-05', '1998-01')",
    "goals_by_month": f"""WITH {_LK}, g AS (SELECT loc_name, year_month, arg_max(total_sales::DOUBLE, week_ending) AS goal FROM lk GROUP BY 1, 2)
SELECT p.loc_name, p.loc_id, year_month, goal FROM (SELECT DISTINCT loc_name, loc_id FROM places) p LEFT JOIN g USING (loc_name)""",
    "current_scan": f"""WITH {facts.WEEKS_SQL}, k AS (SELECT *, dayofyear(week_ending) % 7 AS k FROM lw) SELECT week_ending, loc_name, CASE WHEN k IN (0, 2) THEN 0 ELSE guests END AS guests, CASE WHEN k = 0 THEN 0.0 ELSE service::DOUBLE END AS service, loc_id
  FROM k JOIN (SELECT DISTINCT loc_name, loc_id FROM places) USING (loc_name) WHERE k <> 1""",
    "dict_scan": f"WITH {facts.LINES_SQL} SELECT s_suppkey, stylist_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE loc_name END AS place, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE manager END AS region FROM places",
    "data_block": f"""WITH {facts.WEEKS_SQL}, a AS (SELECT loc_name, platform, list(week_ending::VARCHAR ORDER BY week_ending)[-{WEEKS}:] AS w, list(guests ORDER BY week_ending)[-{WEEKS}:] AS g FROM lw GROUP BY 1, 2)
SELECT loc_name, to_json({{'name': loc_name, 'plat': platform, 'weeks': w, 'guests': g}})::VARCHAR AS block FROM a""",
    "territory_brief": f"""WITH {_LK}, n AS (SELECT week_ending, {kpi.mean_sql("pph")} AS net_pph FROM lk WHERE pph > 0 GROUP BY 1),
t AS (SELECT manager, week_ending, count(*) AS n_locations, arg_min(loc_name, (-pph, loc_name)) AS top_location, max(pph) AS top_pph, arg_min(loc_name, (pph, loc_name)) AS low_location, min(pph) AS low_pph FROM lk GROUP BY 1, 2)
SELECT t.*, top_pph - net_pph AS lead FROM t LEFT JOIN n USING (week_ending)""",
    "brief_rows": f"""WITH {facts.WEEKS_SQL}, w AS (SELECT manager, week_ending, CASE WHEN weekofyear(week_ending) % 3 <> 0 THEN 'guests: ' || sum(guests) END AS b FROM lw GROUP BY 1, 2)
SELECT manager, week_ending, last_value(b IGNORE NULLS) OVER (PARTITION BY manager ORDER BY week_ending) AS brief FROM w""",
    "network_payload": f"""WITH {_LK} SELECT week_ending, coalesce(max(pph) FILTER (pph > 0), 0.0) AS top_pph, coalesce(min(pph) FILTER (pph > 0), 0.0) AS bottom_pph, {kpi.mean_sql("avg_ticket", "avg_ticket > 0")} AS avg_ticket, count(*) AS n_locations FROM lk GROUP BY 1""",
    "location_payload": f"""WITH {_LK}, s AS ({"SELECT stylist_name, loc_name, week_ending, " + kpi.ratios_sql(kpi.STYLIST_RATIOS)} FROM (SELECT *, strftime(week_ending, '%Y-%m') AS year_month FROM ({facts.totals_sql('stylist_name, loc_name, platform, manager, week_ending')}))),
t AS (SELECT loc_name, week_ending, count(*) AS n_stylists, arg_min(stylist_name, (-pph, stylist_name)) AS top_stylist, arg_min(stylist_name, (-pph, stylist_name)) FILTER (pph < 1000) AS watch_stylist, {kpi.mean_sql("avg_ticket", "avg_ticket > 0")} AS avg_ticket FROM s GROUP BY 1, 2)
SELECT w.loc_name, w.week_ending, pph, (sum({kpi.millionths_sql("pph")}) OVER l3)::DOUBLE / 1e6::DOUBLE / (count(*) OVER l3) AS pph_3wk, n_stylists, top_stylist, watch_stylist, t.avg_ticket FROM lk w JOIN t ON t.loc_name = w.loc_name AND t.week_ending = w.week_ending
  WINDOW l3 AS (PARTITION BY w.loc_name ORDER BY w.week_ending ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "live_and_historical": f"""WITH {facts.STYLISTS_SQL}, r AS (SELECT stylist_name, week_ending, guests, row_number() OVER w AS n, lead(guests) OVER w AS before FROM sw WINDOW w AS (PARTITION BY stylist_name ORDER BY week_ending DESC)), e AS (SELECT max(week_ending) AS m FROM sw)
SELECT stylist_name, week_ending, CASE WHEN week_ending = m THEN guests - coalesce(before, 0) END AS change, CASE WHEN week_ending = m THEN 'live' ELSE 'historical' END AS kind FROM r, e WHERE n = 1""",
    "replaced_tails": f"""WITH {facts.STYLISTS_SQL}, a AS (SELECT stylist_name, list(guests::BIGINT ORDER BY week_ending) AS g FROM sw GROUP BY 1), c AS (SELECT *, g[-1] - coalesce(g[-2], 0) AS d FROM a)
SELECT stylist_name, array_to_string(CASE WHEN d >= 0 THEN list_append(g[:-2], d) ELSE g[:-2] END, ',') AS guests FROM c""",
    "rounded_deltas": f"""WITH {_LK}, d AS (SELECT loc_name, week_ending, total_sales::DOUBLE AS now, lag(total_sales::DOUBLE) OVER (PARTITION BY loc_name ORDER BY week_ending) AS before FROM lk)
SELECT loc_name, week_ending, {kpi.rounded_sql("now - before", 2)} AS delta, {kpi.rounded_sql("(now - before) / nullif(abs(before), 0) * 100", 1)} AS delta_pct FROM d""",
    "recognition_alerts": f"""WITH {_LK}, r AS (SELECT loc_name, week_ending, pph, row_number() OVER (PARTITION BY week_ending ORDER BY pph DESC, loc_name) AS top, row_number() OVER (PARTITION BY week_ending ORDER BY pph, loc_name DESC) AS low, count(*) OVER (PARTITION BY week_ending) AS n,
  lag(pph) OVER (PARTITION BY loc_name ORDER BY week_ending) AS before FROM lk)
SELECT loc_name, week_ending, 'RECOGNITION' AS kind, 'LOW' AS severity FROM r WHERE top = 1 UNION ALL SELECT loc_name, week_ending, 'WATCH', 'HIGH' FROM r WHERE low = 1 AND n > 1
UNION ALL SELECT loc_name, week_ending, 'PPH_DROP', 'MEDIUM' FROM r WHERE (pph - before) / nullif(abs(before), 0) * 100 <= -5 UNION ALL SELECT DISTINCT 'ALL LOCATIONS', week_ending, 'COACH BRIEFING', 'LOW' FROM r""",
    "yoy_totals": f"""WITH {_MK}, n AS (SELECT loc_name, year_month, total_sales AS now FROM mk),
p AS (SELECT loc_name, (left(year_month, 4)::INT + 1) || substr(year_month, 5) AS year_month, total_sales AS prior_year FROM mk),
t AS (SELECT loc_name, year_month, now, prior_year, CASE WHEN loc_name NOT LIKE '%5' THEN (prior_year * 1.10::DECIMAL(4,2))::DECIMAL(18,2) END AS goal, coalesce(now, 0) AS w FROM n FULL JOIN p USING (loc_name, year_month) WHERE year_month IN (SELECT year_month FROM mk)),
u AS (SELECT * FROM t UNION ALL SELECT 'TOTALS', year_month, sum(now), sum(prior_year), sum(goal), sum(w) FILTER (goal IS NOT NULL) FROM t GROUP BY 2)
SELECT loc_name, year_month, now::DOUBLE AS now, goal::DOUBLE AS goal, prior_year::DOUBLE AS prior_year, w::DOUBLE / nullif(goal::DOUBLE, 0) AS goal_pct, (now::DOUBLE - prior_year::DOUBLE) / nullif(prior_year::DOUBLE, 0) AS yoy_pct FROM u""",
    "merged_sources": f"""WITH {facts.WEEKS_SQL}, k AS (SELECT *, weekofyear(week_ending) % 5 > 1 AS hit FROM lw)
SELECT loc_name, week_ending - 6 AS period_start, week_ending AS period_end, guests, CASE WHEN hit THEN service::DOUBLE END AS other_service, hit AS merged FROM k""",
    "flattened": f"WITH {facts.STYLISTS_SQL} SELECT loc_name, week_ending, stylist_name, guests FROM sw",
    "drift_by_location": f"""WITH {_LK}, t AS (SELECT loc_name, {kpi.mean_sql("pph")} AS m FROM lk WHERE loc_name NOT LIKE '%2' GROUP BY 1)
SELECT loc_name, week_ending, pph, CASE WHEN pph < m / 2 THEN 'low' ELSE 'high' END AS drift FROM lk JOIN t USING (loc_name) WHERE pph < m / 2 OR pph > m * 2""",
    "categorised": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'uncategorised' WHEN o_orderkey % 2 = 0 THEN 'urgent' ELSE 'later' END AS category FROM orders",
}
