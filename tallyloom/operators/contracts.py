"""Rows and names under their contracts: calendars and labels, names of places and columns, the wide location row and its narrower forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import calendar, kpi, parsing
from tallyloom.functions.kpi import rounded
from tallyloom.operators.coverage import longest_alias
from tallyloom.sources import facts
from tallyloom.sources.tables import parquet

WEEK, MONEY = "week_ending", facts.MONEY
# The columns of a location's row, of which those that no source has yet are null.
LOCATION_ROW = (
    "location_id", "location_name_canonical", "tableau_center_name", "pos_system", "period_start", "period_end", "period_type", "period_label", "guest_count", "total_sales_net", "service_net", "product_net", "productive_hours", "product_pct",
    "ppg_net", "avg_ticket", "pph_net", "wax_count", "wax_net", "color_net", "treatment_count", "treatment_net", "wax_pct", "color_pct", "treatment_pct", "projection", "monthly_goal", "daily_goal",
    "prior_year_total_sales", "prior_year_guest_count", "prior_year_ppg", "prior_year_avg_ticket", "ppg_diff_yoy", "avg_ticket_diff_yoy", "sales_pct_yoy", "baseline_2019_total", "source_extract_hash", "generated_at", "data_complete_flag",
)
#: Of those, the ones that a narrower row has, under its names.
CUMULATIVE = {
    "loc_name": "location_name_canonical", "platform": "pos_system", "guests": "guest_count", "total_sales": "total_sales_net", "service": "service_net", "product": "product_net", "product_pct": "product_pct", "ppg": "ppg_net", "pph": "pph_net",
    "avg_ticket": "avg_ticket", "prod_hours": "productive_hours", "wax_count": "wax_count", "wax": "wax_net", "wax_pct": "wax_pct", "color": "color_net", "color_pct": "color_pct", "treat_count": "treatment_count", "treat": "treatment_net", "treat_pct": "treatment_pct",
}


def sundays(year_month: Column) -> Column:
    """The Sundays of a month as an array of dates."""
    first = calendar.month_start(year_month)
    return F.filter(F.sequence(first, F.last_day(first)), lambda d: F.dayofweek(d) == 1)


def period(week_ending: Column) -> Column:
    """struct(start, end, type, label) of the month so far at a week's end."""
    return F.struct(F.trunc(week_ending, "month").alias("start"), week_ending.alias("end"), F.lit("mtd").alias("type"), F.concat(F.lit("MTD thru "), F.date_format(week_ending, "yyyy-MM-dd")).alias("label"))


def period_start(text: Column) -> Column:
    """Six days before a date in one of three formats, as ISO text; other text stays as it is, and null is empty."""
    day = F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "M/d/yyyy"), F.try_to_date(text, "d-MMM-yyyy"))
    return F.coalesce(F.date_format(F.date_sub(day, 6), "yyyy-MM-dd"), text, F.lit(""))


def place(raw: Column, aliases: dict[str, str]) -> Column:
    """The canonical name of a place: by alias without regard to case, else as it is, trimmed; null is Unknown."""
    t = F.trim(raw)
    known = F.create_map(*(F.lit(x) for a, name in aliases.items() for x in (a.lower(), name)))
    return F.coalesce(F.try_element_at(known, F.lower(t)), t, F.lit("Unknown"))


def header_place(text: Column, aliases: tuple[tuple[str, str], ...]) -> Column:
    """The place that a report's header names in either form, by the longest alias in it, else the name itself without what stands in brackets."""
    found = F.coalesce(F.nullif(F.regexp_extract(text, r"(?im)^Center(?: Name)?:\s*(.+)$", 1), F.lit("")), F.nullif(F.regexp_extract(text, r"(?im)^Store name:\s*(.+)$", 1), F.lit("")))
    clean = F.trim(F.regexp_replace(found, r"\([^)]*\)|\s+FS$", ""))
    return F.coalesce(longest_alias(found, aliases), clean)


def column_fields(cells: DataFrame, keys: list[str], fields: dict[str, tuple[str, str]], flip: str) -> DataFrame:
    """(keys, c, field) of a header row (keys, c, v) whose labels mean one thing up to the marker `flip` and another after it."""
    label = parsing.header(F.col("v"))
    w = Window.partitionBy(*keys).orderBy("c").rowsBetween(Window.unboundedPreceding, 0)
    after = F.max((label == flip).cast("int")).over(w)
    first, second = (F.create_map(*(F.lit(x) for k, v in fields.items() for x in (k, v[i]))) for i in (0, 1))
    out = cells.withColumn("field", F.when(after == 1, F.try_element_at(second, label)).otherwise(F.try_element_at(first, label)))
    return out.where("field IS NOT NULL").select(*keys, "c", "field")


def sorted_json_hash(columns: list[str]) -> Column:
    """SHA-256 of the columns as JSON with its keys in order."""
    return F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"}), 256)


def location_row(df: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """The wide row, 39 columns, of df(location_id, name, center, pos, period, guests, service, product, hours, categories, goal, source).

    Ratios without a denominator are null; the row is complete if all it is computed from is there. generated_at is by default now.
    """
    stamp = F.date_format(F.current_timestamp() if generated_at is None else generated_at, "yyyy-MM-dd'T'HH:mm:ss")
    d = lambda c: F.col(c).cast("double")
    div = lambda a, b, n: rounded(F.try_divide(a, b), n)
    s, p, g, h = d("service"), d("product"), d("guests"), d("prod_hours")
    t = s + p
    null = F.lit(None).cast("double")
    have = [g, t, s, p, h]
    complete = have[0].isNotNull()
    for x in have[1:]:
        complete = complete & x.isNotNull()
    values = {
        "location_id": F.col("location_id"), "location_name_canonical": F.col("loc_name"), "tableau_center_name": F.col("center"), "pos_system": F.col("platform"), "period_start": F.col("period.start"), "period_end": F.col("period.end"), "period_type": F.col("period.type"),
        "period_label": F.col("period.label"), "guest_count": g, "total_sales_net": t, "service_net": s, "product_net": p, "productive_hours": h, "product_pct": div(p, t, 4), "ppg_net": div(p, g, 2), "avg_ticket": div(t, g, 2), "pph_net": div(t, h, 2),
        "wax_count": d("wax_count"), "wax_net": d("wax"), "color_net": d("color"), "treatment_count": d("treat_count"), "treatment_net": d("treat"), "wax_pct": div(d("wax_count"), g, 4), "color_pct": div(d("color"), s, 4), "treatment_pct": div(d("treat_count"), g, 4),
        "projection": rounded(t / 2, 2) * 25, "monthly_goal": d("goal"), "daily_goal": rounded(d("goal") / 26, 2), "source_extract_hash": F.sha2("source", 256), "generated_at": stamp, "data_complete_flag": complete,
    }
    return df.select(*(values.get(c, null).alias(c) for c in LOCATION_ROW))


def _weeks(spark, sf_dir) -> DataFrame:
    """Location weeks with ids, goals (by id, else by name; some have none), and what they are read from. Every ninth week lacks hours."""
    w = facts.location_weeks(spark, sf_dir)
    ids = facts.places(spark, sf_dir).select("loc_name", F.col("loc_id").cast("long").alias("location_id")).distinct()
    w = w.join(ids, "loc_name").withColumns({"prod_hours": F.when(F.weekofyear(WEEK) % 9 != 0, F.col("prod_hours")), "period": period(F.col(WEEK)), "center": F.when(F.col("platform") == "zenoti", F.concat(F.lit("888-"), F.col("location_id"), F.lit("-"), F.col("loc_name")))})
    by_id = ids.where("location_id % 3 = 0").select("location_id", (F.col("location_id") * 1000 + 500).cast("double").alias("_a"))
    by_name = ids.where("location_id % 3 = 1").select("loc_name", (F.col("location_id") * 100).cast("double").alias("_b"))
    return w.join(by_id, "location_id", "left").join(by_name, "loc_name", "left").withColumns({"goal": F.coalesce("_a", "_b"), "source": F.concat_ws("/", "loc_name", F.date_format(WEEK, "yyyy-MM-dd"))})


def location_rows(spark, sf_dir):
    return location_row(_weeks(spark, sf_dir), F.col(WEEK)).drop("prior_year_total_sales", "prior_year_guest_count", "prior_year_ppg", "prior_year_avg_ticket", "ppg_diff_yoy", "avg_ticket_diff_yoy", "sales_pct_yoy", "baseline_2019_total")


def cumulative_rows(spark, sf_dir):
    """The wide rows in their 22-column form."""
    r = location_row(_weeks(spark, sf_dir))
    return r.select(F.date_format("period_end", "yyyy-MM").alias("year_month"), F.col("period_end").alias(WEEK), *(F.col(a).alias(b) for b, a in CUMULATIVE.items()), F.lit("weekly").alias("source"))


def month_frame(spark, sf_dir):
    """A location's windows of a month as rows of one frame: its weeks, and the month so far at its end."""
    w = facts.location_weeks(spark, sf_dir)
    weekly = w.select("loc_name", "year_month", F.lit("weekly").alias("period_type"), F.greatest(F.date_sub(WEEK, 6), F.trunc(WEEK, "month")).alias("period_start"), F.col(WEEK).alias("period_end"), "guests", (F.col("service") + F.col("product")).alias("total_sales"))
    mtd = w.groupBy("loc_name", "year_month").agg(F.max(WEEK).alias("period_end"), F.sum("guests").alias("guests"), F.sum(F.col("service") + F.col("product")).alias("total_sales"))
    mtd = mtd.select("loc_name", "year_month", F.lit("mtd").alias("period_type"), F.trunc("period_end", "month").alias("period_start"), "period_end", "guests", F.col("total_sales").cast("decimal(38,2)").alias("total_sales"))
    return kpi.plain(weekly.withColumn("total_sales", F.col("total_sales").cast("decimal(38,2)")).unionByName(mtd), ["loc_name", "year_month", "period_type", "period_start", "period_end", "guests", "total_sales"])


def projections(spark, sf_dir):
    """The three projections: by working days, by half the sales for each of 25 days, and by a seventh for each of 24."""
    w = kpi.with_ratios(facts.location_weeks(spark, sf_dir)).select("loc_name", WEEK, "year_month", F.col("total_sales").cast("double").alias("total_sales"))
    p = calendar.projected(w, "total_sales")
    return p.select("loc_name", WEEK, F.col("projection").alias("by_working_days"), (rounded(F.col("total_sales") / 2, 2) * 25).alias("by_two_days"), (F.col("total_sales") / 7 * 24).alias("by_week"))


def requests_and_guests(spark, sf_dir):
    """A stylist's request share (counted on one system, stated in percent on the other) and product a guest (by invoices, where there are any)."""
    s = facts.stylist_weeks(spark, sf_dir)
    z = F.col("platform") == "zenoti"
    asked = F.col("wax_count")
    req = F.when(z, kpi.ratio(asked, F.col("guests"))).otherwise(F.col("treat_count").cast("double") * 10 / 100)
    invoices = F.when(z, F.col("guests") - F.col("wax_count"))
    base = F.when(invoices > 0, invoices).otherwise(F.col("guests"))
    return s.select("stylist_name", "loc_name", WEEK, req.alias("req_pct"), kpi.ratio(F.col("product"), base).alias("ppg"))


def month_sundays(spark, sf_dir):
    m = facts.location_weeks(spark, sf_dir).select("year_month").distinct()
    return m.select("year_month", F.explode(sundays(F.col("year_month"))).alias("sunday"))


def period_labels(spark, sf_dir):
    return facts.location_weeks(spark, sf_dir).select(WEEK).distinct().select(WEEK, period(F.col(WEEK)).alias("p")).select(WEEK, F.col("p.start").alias("period_start"), F.col("p.type").alias("period_type"), F.col("p.label").alias("period_label"))


def period_starts(spark, sf_dir):
    """Period ends in three known formats and one unknown."""
    o = parquet(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    k = F.col("o_orderkey") % 4
    t = F.when(k == 0, F.date_format("d", "yyyy-MM-dd")).when(k == 1, F.date_format("d", "M/d/yyyy")).when(k == 2, F.date_format("d", "d-MMM-yyyy")).otherwise(F.date_format("d", "dd.MM.yyyy"))
    return o.select("o_orderkey", period_start(t).alias("period_start"))


def newer_location(df: DataFrame) -> DataFrame:
    """The 24 columns of the newer location table: missing numbers are 0, missing text is empty, a missing flag is solid, shares over one are percents."""
    n = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    t = lambda c, default="": F.coalesce(F.col(c).cast("string"), F.lit(default))
    share = lambda c: parsing.fraction(n(c))
    end = t(WEEK)
    values = {
        "location": t("loc_name"), "period_start": period_start(end), "period_end": end, "pos_system": t("platform"), "guest_count": n("guests").cast("long"), "total_sales": n("total_sales"), "service_net": n("service"), "product_net": n("product"),
        "product_pct": share("product_pct"), "ppg_net": n("ppg"), "pph_net": n("pph"), "avg_ticket": n("avg_ticket"), "productive_hours": n("prod_hours"), "wax_count": n("wax_count"), "wax_net": n("wax"), "wax_pct": share("wax_pct"),
        "color_net": n("color"), "color_pct": share("color_pct"), "treatment_count": n("treat_count"), "treatment_net": n("treat"), "treatment_pct": share("treat_pct"), "flag": t("flag", "solid"), "coach": t("manager"), "coach_emoji": t("emoji"),
    }
    return df.select(*(v.alias(k) for k, v in values.items()))


def newer_location_rows(spark, sf_dir):
    """Location weeks whose shares are percents and whose flags are mostly missing."""
    w = kpi.with_ratios(facts.location_weeks(spark, sf_dir))
    w = w.withColumns({c: F.col(c) * 100 for c in ("product_pct", "wax_pct", "color_pct", "treat_pct")})
    return newer_location(w.withColumns({"flag": F.when(F.col("guests") > 5, "star"), "emoji": F.lit(None).cast("string")}))


def newer_stylist_rows(spark, sf_dir):
    """The last element of each stylist's histories; tenure from one of two columns."""
    s = facts.stylist_weeks(spark, sf_dir)
    row = F.struct(WEEK, "loc_name", "guests", "color", "manager", kpi.ratio(F.col("product"), F.col("service") + F.col("product")).alias("share"))
    h = s.groupBy("stylist_name").agg(F.sort_array(F.collect_list(row)).alias("h"), F.datediff(F.max(WEEK), F.min(WEEK)).alias("d"))
    last = lambda c: F.try_element_at("h", F.lit(-1))[c]
    tenure = F.coalesce(F.lit(None).cast("double"), F.col("d") / 365.0)
    return h.select(last(WEEK).cast("string").alias("period_end"), "stylist_name", last("loc_name").alias("location"), F.lit("active").alias("status"), tenure.alias("tenure_years"), parsing.fraction(last("share") * 100).alias("product_pct"), last("guests").cast("double").alias("services"), last("color").cast("double").alias("color"), last("manager").alias("coach"))


ALIASES = {f"n {i}": f"NATION_{i}" for i in range(0, 25, 2)}


def place_names(spark, sf_dir):
    """Names of places as typed: an alias in capitals for even ones, as they are for odd ones, null for every fifth."""
    n = parquet(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("n_nationkey")
    raw = F.when(k % 5 == 4, F.lit(None)).when(k % 2 == 0, F.concat(F.lit(" N "), k)).otherwise(F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")))
    return n.select("n_nationkey", place(raw, ALIASES).alias("place"))


def header_places(spark, sf_dir):
    """Places from report headers of two forms, with a remark behind them or an alias in them."""
    n = parquet(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("n_nationkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("Summary\nCenter Name: "), F.col("n_name"), F.lit(" (north)\nx"))).when(k % 3 == 1, F.concat(F.lit("Store name: "), F.col("n_name"), F.lit(" FS\ny"))).otherwise(F.concat(F.lit("Center: the old mill no. "), k))
    return n.select("n_nationkey", header_place(text, (("old mill", "Mill"),)).alias("place"))


def managers_and_systems(spark, sf_dir):
    """Who leads a location and what system it has, looked up by name; a name not known gives neither."""
    known = facts.places(spark, sf_dir).select("loc_name", "manager", "platform").distinct()
    asked = parquet(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 6 == 5, "elsewhere").otherwise(F.col("n_name")).alias("loc_name"))
    return asked.join(known, "loc_name", "left").select("n_nationkey", "loc_name", "manager", "platform")


def section_headers(spark, sf_dir):
    """Headers whose labels come twice, before and after the marker."""
    sheets = facts.location_weeks(spark, sf_dir).select("loc_name").distinct()
    labels = ["Salon", "Total", "Guests", " YoY ", "Total", "guests", "Other"]
    cells = sheets.select("loc_name", F.posexplode(F.array(*map(F.lit, labels))).alias("c", "v"))
    out = column_fields(cells, ["loc_name"], {"salon": ("name", "name"), "total": ("total_sales", "prior_total_sales"), "guests": ("guests", "prior_guests")}, "yoy")
    return kpi.plain(out, out.columns)


def json_hashes(spark, sf_dir):
    w = facts.location_weeks(spark, sf_dir).select("loc_name", WEEK, F.date_format(WEEK, "yyyy-MM-dd").alias("w"), F.col("guests").cast("long").alias("guests"))
    return w.select("loc_name", WEEK, sorted_json_hash(["w", "loc_name", "guests"]).alias("sha256"))


def brief_map(spark, sf_dir):
    """Briefs by manager with keys trimmed in lower case, empty ones left out."""
    r = parquet(spark, sf_dir, "region").select("r_regionkey", "r_name")
    m = r.agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit(" "), F.upper("r_name"), F.lit(" ")).alias("k"), F.when(F.col("r_regionkey") % 2 == 0, F.concat(F.lit("see "), F.col("r_name"))).otherwise(" ").alias("v")))).alias("m"))
    return m.select(F.explode(F.transform_keys(F.map_filter("m", lambda k, v: F.trim(v) != ""), lambda k, v: F.lower(F.trim(k)))).alias("manager", "brief"))


def latest_stylist_rows(spark, sf_dir):
    """The newer stylist row: the last element of each history, and tenure from one of two columns."""
    s = facts.stylist_weeks(spark, sf_dir)
    h = s.groupBy("stylist_name").agg(F.sort_array(F.collect_list(F.struct(WEEK, "guests"))).alias("h"), F.min(WEEK).alias("first"), F.max(WEEK).alias("last"))
    tenure, other = F.when(F.length("stylist_name") % 2 == 0, F.datediff("last", "first")), F.datediff("last", "first") + 1
    return h.select("stylist_name", F.try_element_at("h", F.lit(-1))["guests"].cast("long").alias("guests"), F.coalesce(tenure, other).cast("long").alias("tenure_days"), F.try_element_at("h", F.lit(-99999))["guests"].cast("long").alias("before_all"))


def top_lists(spark, sf_dir):
    """The first 7, 20 and 60 orders of each month by worth, told apart: the lists that reports end at."""
    o = parquet(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("year_month"), F.col("o_totalprice").cast(MONEY).alias("worth"))
    o = o.withColumn("place", F.row_number().over(Window.partitionBy("year_month").orderBy(F.col("worth").desc(), "o_orderkey")).cast("long")).where("place <= 60")
    return o.select("year_month", "o_orderkey", "place", F.when(F.col("place") <= 7, "first").when(F.col("place") <= 20, "second").otherwise("third").alias("list"))


def common_people(spark, sf_dir):
    """Persons of every location who came in both of two years: a set operation."""
    v = facts.visits(spark, sf_dir)
    of = lambda y: v.where(F.year("day") == y).select("loc_name", "person")
    return of(1996).intersect(of(1997))


def recipients(spark, sf_dir):
    """For whom a page is meant, by its host: the first rule that fits."""
    p = parquet(spark, sf_dir, "pages").select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    kind = F.when(F.col("url").contains("blog."), "writer").when(F.col("url").contains("spam"), "nobody").when(F.col("url").rlike(r"\.net(/|$)"), "team").otherwise("client")
    return p.select("page_id", kind.alias("recipient"))


def zero_after_five(spark, sf_dir):
    """Counts of zero in a week where the location's mean over its four weeks before was five at least."""
    w = Window.partitionBy("loc_name").orderBy(WEEK).rowsBetween(-4, -1)
    r = facts.location_weeks(spark, sf_dir)
    r = r.select("loc_name", WEEK, "wax_count", kpi.ratio(F.sum("wax_count").over(w), F.count("*").over(w), kpi.NULL).alias("usual"))
    return r.where((F.col("wax_count") == 0) & (F.col("usual") >= 5)).select("loc_name", WEEK, "usual", F.lit("fail").alias("status"))


def around_moves(spark, sf_dir):
    """Mean worth of the person's visits in the 28 days before a move and from it on; a visit without worth counts as 0."""
    from tallyloom.operators.people import moves

    v = facts.visits(spark, sf_dir).withColumn("revenue", F.when(F.col("visit") % 10 != 0, F.col("revenue")))
    d = F.datediff("day", F.lit("1970-01-01").cast("date")).cast("long")
    worth = F.coalesce("revenue", F.lit(0).cast(MONEY))
    before, after = (Window.partitionBy("person").orderBy("_d").rangeBetween(*r) for r in ((-28, -1), (0, 28)))
    v = v.withColumn("_d", d).withColumns({n: kpi.ratio(F.sum(worth).over(w), F.count("*").over(w), kpi.NULL) for n, w in (("pre", before), ("post", after))})
    return moves(v).select("person", "visit", rounded(F.col("pre"), 2).alias("pre"), rounded(F.col("post"), 2).alias("post"))


QUERIES = {
    f.__name__: f
    for f in (
        location_rows, cumulative_rows, month_frame, projections, requests_and_guests, month_sundays, period_labels, period_starts, place_names, header_places, managers_and_systems, section_headers, json_hashes, brief_map,
        latest_stylist_rows, top_lists, common_people, recipients, zero_after_five, around_moves, newer_location_rows, newer_stylist_rows,
    )
}

_DIV = lambda a, b, n: kpi.rounded_sql(f"({a}) / nullif({b}, 0)", n)
_ROWS = f"""{facts.WEEKS_SQL},
z AS (SELECT lw.*, loc_id, service::DOUBLE AS s, product::DOUBLE AS p, service::DOUBLE + product::DOUBLE AS t, guests::DOUBLE AS g, CASE WHEN weekofyear(week_ending) % 9 <> 0 THEN prod_hours::DOUBLE END AS h,
  CASE loc_id % 3 WHEN 0 THEN loc_id * 1000.0::DOUBLE + 500 WHEN 1 THEN loc_id * 100.0::DOUBLE END AS goal FROM lw JOIN (SELECT DISTINCT loc_name, loc_id FROM places) USING (loc_name)),
wide AS (SELECT loc_id AS location_id, loc_name AS location_name_canonical, CASE WHEN platform = 'zenoti' THEN '888-' || loc_id || '-' || loc_name END AS tableau_center_name, platform AS pos_system, date_trunc('month', week_ending)::DATE AS period_start, week_ending AS period_end,
  'mtd' AS period_type, 'MTD thru ' || week_ending AS period_label, g AS guest_count, t AS total_sales_net, s AS service_net, p AS product_net, h AS productive_hours, {_DIV("p", "t", 4)} AS product_pct, {_DIV("p", "g", 2)} AS ppg_net, {_DIV("t", "g", 2)} AS avg_ticket,
  {_DIV("t", "h", 2)} AS pph_net, wax_count::DOUBLE AS wax_count, wax::DOUBLE AS wax_net, color::DOUBLE AS color_net, treat_count::DOUBLE AS treatment_count, treat::DOUBLE AS treatment_net, {_DIV("wax_count::DOUBLE", "g", 4)} AS wax_pct, {_DIV("color::DOUBLE", "s", 4)} AS color_pct,
  {_DIV("treat_count::DOUBLE", "g", 4)} AS treatment_pct, {kpi.rounded_sql("t / 2", 2)} * 25 AS projection, goal AS monthly_goal, {kpi.rounded_sql("goal / 26", 2)} AS daily_goal, sha256(loc_name || '/' || week_ending) AS source_extract_hash, strftime(week_ending, '%Y-%m-%dT%H:%M:%S') AS generated_at, h IS NOT NULL AS data_complete_flag FROM z)"""
_FRACTION = "CASE WHEN abs({x}) <= 1 THEN {x} ELSE {x} / 100 END"
ORACLE = {
    "location_rows": f"WITH {_ROWS} SELECT * FROM wide",
    "cumulative_rows": f"WITH {_ROWS} SELECT strftime(period_end, '%Y-%m') AS year_month, period_end AS week_ending, {', '.join(f'{a} AS {b}' for b, a in CUMULATIVE.items())}, 'weekly' AS source FROM wide",
    "month_frame": f"""WITH {facts.WEEKS_SQL} SELECT loc_name, year_month, 'weekly' AS period_type, greatest(week_ending - 6, date_trunc('month', week_ending)::DATE) AS period_start, week_ending AS period_end, guests, (service + product)::DOUBLE AS total_sales FROM lw
UNION ALL SELECT loc_name, year_month, 'mtd', date_trunc('month', max(week_ending))::DATE, max(week_ending), sum(guests)::BIGINT, sum(service + product)::DOUBLE FROM lw GROUP BY 1, 2""",
    "projections": f"""WITH {facts.WEEKS_SQL}, d AS (SELECT loc_name, week_ending, (service + product)::DOUBLE AS t, date_trunc('month', week_ending)::DATE AS first FROM lw),
c AS (SELECT *, len(list_filter(range(first, week_ending + 1, INTERVAL 1 DAY), lambda x: isodow(x) < 7)) AS a, len(list_filter(range(first, last_day(week_ending) + 1, INTERVAL 1 DAY), lambda x: isodow(x) < 7)) AS b FROM d)
SELECT loc_name, week_ending, t / nullif(a::DOUBLE, 0) * b AS by_working_days, {kpi.rounded_sql("t / 2", 2)} * 25 AS by_two_days, t / 7 * 24 AS by_week FROM c""",
    "requests_and_guests": f"""WITH {facts.STYLISTS_SQL} SELECT stylist_name, loc_name, week_ending, CASE WHEN platform = 'zenoti' THEN coalesce(wax_count::DOUBLE / nullif(guests, 0), 0.0) ELSE treat_count::DOUBLE * 10 / 100 END AS req_pct,
  coalesce(product::DOUBLE / nullif(CASE WHEN platform = 'zenoti' AND guests - wax_count > 0 THEN guests - wax_count ELSE guests END, 0), 0.0) AS ppg FROM sw""",
    "month_sundays": f"""WITH {facts.WEEKS_SQL}, m AS (SELECT DISTINCT year_month, (year_month || '-01')::DATE AS f FROM lw), d AS (SELECT year_month, unnest(range(f, last_day(f) + 1, INTERVAL 1 DAY))::DATE AS sunday FROM m) SELECT * FROM d WHERE isodow(sunday) = 7""",
    "period_labels": f"WITH {facts.WEEKS_SQL} SELECT DISTINCT week_ending, date_trunc('month', week_ending)::DATE AS period_start, 'mtd' AS period_type, 'MTD thru ' || week_ending AS period_label FROM lw",
    "period_starts": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN (o_orderdate::DATE - 6)::VARCHAR ELSE strftime(o_orderdate, '%d.%m.%Y') END AS period_start FROM orders",
    "newer_location_rows": f"""WITH {facts.WEEKS_SQL}, k AS (SELECT *, service::DOUBLE AS s, product::DOUBLE AS p, guests::DOUBLE AS g FROM lw), r AS (SELECT *, {kpi.ratios_sql()} FROM k)
SELECT loc_name AS location, (week_ending - 6)::VARCHAR AS period_start, week_ending::VARCHAR AS period_end, platform AS pos_system, guests AS guest_count, (service + product)::DOUBLE AS total_sales, s AS service_net, p AS product_net,
  {_FRACTION.format(x="(product_pct * 100)")} AS product_pct, ppg AS ppg_net, pph AS pph_net, avg_ticket, prod_hours::DOUBLE AS productive_hours, wax_count::DOUBLE AS wax_count, wax::DOUBLE AS wax_net, {_FRACTION.format(x="(wax_pct * 100)")} AS wax_pct,
  color::DOUBLE AS color_net, {_FRACTION.format(x="(color_pct * 100)")} AS color_pct, treat_count::DOUBLE AS treatment_count, treat::DOUBLE AS treatment_net, {_FRACTION.format(x="(treat_pct * 100)")} AS treatment_pct,
  CASE WHEN guests > 5 THEN 'star' ELSE 'solid' END AS flag, manager AS coach, '' AS coach_emoji FROM r""",
    "newer_stylist_rows": f"""WITH {facts.STYLISTS_SQL}, a AS (SELECT stylist_name, max(week_ending)::VARCHAR AS period_end, arg_max(loc_name, week_ending) AS location, arg_max(guests, week_ending)::DOUBLE AS services, arg_max(color, week_ending)::DOUBLE AS color,
  arg_max(product::DOUBLE / nullif((service + product)::DOUBLE, 0), week_ending) AS share, arg_max(manager, week_ending) AS coach, max(week_ending) - min(week_ending) AS d FROM sw GROUP BY 1)
SELECT period_end, stylist_name, location, 'active' AS status, d / 365.0::DOUBLE AS tenure_years, {_FRACTION.format(x="(coalesce(share, 0.0) * 100)")} AS product_pct, services, color, coach FROM a""",
    "place_names": "SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 4 THEN 'Unknown' ELSE n_name END AS place FROM nation",
    "header_places": "SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 2 THEN 'Mill' ELSE n_name END AS place FROM nation",
    "managers_and_systems": f"""WITH {facts.LINES_SQL}, k AS (SELECT DISTINCT loc_name, manager, platform FROM places), a AS (SELECT n_nationkey, CASE WHEN n_nationkey % 6 = 5 THEN 'elsewhere' ELSE n_name END AS loc_name FROM nation)
SELECT n_nationkey, loc_name, manager, platform FROM a LEFT JOIN k USING (loc_name)""",
    "section_headers": f"""WITH {facts.WEEKS_SQL}, l AS (SELECT DISTINCT loc_name FROM lw), f AS (SELECT * FROM (VALUES (0, 'name'), (1, 'total_sales'), (2, 'guests'), (4, 'prior_total_sales'), (5, 'prior_guests')) t(c, field)) SELECT loc_name, c, field FROM l, f""",
    "json_hashes": f"""WITH {facts.WEEKS_SQL} SELECT loc_name, week_ending, sha256('{{"guests":' || guests || ',"loc_name":"' || loc_name || '","w":"' || week_ending || '"}}') AS sha256 FROM lw""",
    "brief_map": "SELECT lower(trim(r_name)) AS manager, 'see ' || r_name AS brief FROM region WHERE r_regionkey % 2 = 0",
    "latest_stylist_rows": f"""WITH {facts.STYLISTS_SQL} SELECT stylist_name, arg_max(guests, week_ending) AS guests, (max(week_ending) - min(week_ending)) + CASE WHEN length(stylist_name) % 2 = 0 THEN 0 ELSE 1 END AS tenure_days, NULL::BIGINT AS before_all FROM sw GROUP BY 1""",
    "top_lists": """WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS year_month, o_orderkey, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_totalprice::DECIMAL(18,2) DESC, o_orderkey) AS place FROM orders)
SELECT *, CASE WHEN place <= 7 THEN 'first' WHEN place <= 20 THEN 'second' ELSE 'third' END AS list FROM o WHERE place <= 60""",
    "common_people": f"WITH {facts.VISITS_SQL} SELECT loc_name, person FROM visits WHERE year(day) = 1996 INTERSECT SELECT loc_name, person FROM visits WHERE year(day) = 1997",
    "recipients": "SELECT page_id, CASE WHEN u LIKE '%blog.%' THEN 'writer' WHEN u LIKE '%spam%' THEN 'nobody' WHEN regexp_matches(u, '\\.net(/|$)') THEN 'team' ELSE 'client' END AS recipient FROM (SELECT page_id, coalesce(url, '') AS u FROM pages)",
    "zero_after_five": f"""WITH {facts.WEEKS_SQL}, r AS (SELECT loc_name, week_ending, wax_count, sum(wax_count) OVER w::DOUBLE / nullif(count(*) OVER w, 0) AS usual FROM lw WINDOW w AS (PARTITION BY loc_name ORDER BY week_ending ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))
SELECT loc_name, week_ending, usual, 'fail' AS status FROM r WHERE wax_count = 0 AND usual >= 5""",
    "around_moves": f"""WITH {facts.VISITS_SQL}, v AS (SELECT * REPLACE (CASE WHEN visit % 10 <> 0 THEN revenue ELSE 0 END AS revenue), lag(loc_name) OVER (PARTITION BY person ORDER BY day, visit) AS from_loc FROM visits),
m AS (SELECT * FROM v WHERE from_loc <> loc_name),
a AS (SELECT m.person, m.visit, sum(o.revenue) FILTER (o.day < m.day)::DOUBLE / nullif(count(*) FILTER (o.day < m.day), 0) AS pre, sum(o.revenue) FILTER (o.day >= m.day)::DOUBLE / nullif(count(*) FILTER (o.day >= m.day), 0) AS post
  FROM m JOIN v o ON o.person = m.person AND o.day BETWEEN m.day - 28 AND m.day + 28 GROUP BY 1, 2)
SELECT person, visit, {kpi.rounded_sql("pre", 2)} AS pre, {kpi.rounded_sql("post", 2)} AS post FROM a""",
}
