"""Parsed documents with nested employees and categories, made into the rows that tables hold, and files read from folders into them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import kpi, parsing
from tallyloom.functions.kpi import rounded
from tallyloom.operators.summaries import is_artifact, sales_and_hours
from tallyloom.operators.summaries import _texts as summary_texts
from tallyloom.sources import facts
from tallyloom.sources.reports import reports
from tallyloom.sources.tables import delimited, json_lines, report_files
from tallyloom.sources.work import work_folder

KEYS = ["loc_name", "year_month"]


def location_lookup(locations: DataFrame) -> DataFrame:
    """(alias, name, platform, id) of locations(name, platform, id): the lower-case name, and it without a last ` FS`; of several with one alias the least name."""
    name = F.trim("name")
    alias = F.explode(F.array_distinct(F.array(F.lower(name), F.lower(F.regexp_replace(name, r"(?i)\s+FS$", "")))))
    return locations.where(F.coalesce(name, F.lit("")) != "").select(alias.alias("alias"), name.alias("name"), "platform", "id").groupBy("alias").agg(F.min(F.struct("name", "platform", "id")).alias("_l")).select("alias", "_l.*")


def current_row(docs: DataFrame) -> DataFrame:
    """A location's row from a document's struct of figures and map of categories; amounts to the cent, shares to four digits."""
    f = lambda c: F.col(f"figures.{c}").cast("double")
    cat = lambda k, c: F.coalesce(F.try_element_at("categories", F.lit(k))[c].cast("double"), F.lit(0.0))
    total = rounded(f("service") + f("product"), 2)
    share = lambda a, b: F.coalesce(rounded(F.try_divide(a, b), 4), F.lit(0.0))
    return docs.select(*KEYS, F.col("platform"), f("guests").alias("guests"), total.alias("total_sales"), rounded(f("service"), 2).alias("service"), rounded(f("product"), 2).alias("product"), share(f("product"), total).alias("product_pct"), cat("wax", "qty").alias("wax_count"), cat("wax", "sales").alias("wax"), share(cat("color", "sales"), f("service")).alias("color_pct"))


def employee_rows(docs: DataFrame) -> DataFrame:
    """A row an employee of documents with nested employees: no blank names, no artifacts, none without sales and hours."""
    e = docs.select(*KEYS, "platform", F.explode("employees").alias("e")).select(*KEYS, "platform", "e.*")
    dead = (F.coalesce("service", F.lit(0)) <= 0) & (F.coalesce("product", F.lit(0)) <= 0) & (F.coalesce("hours", F.lit(0)) <= 0)
    return e.where((F.coalesce(F.trim("name"), F.lit("")) != "") & ~is_artifact(F.col("name")) & ~dead)


def monthly_staff(rows: DataFrame) -> DataFrame:
    """Employees under one contract, by system: one counts requests and invoices, the other states shares and times."""
    z = F.col("platform") == "zenoti"
    d = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return rows.select(*KEYS, "platform", "name", d("guests").alias("guests"), F.when(z, div(d("service") + d("product"), d("guests"))).otherwise(d("ticket_stated")).alias("avg_ticket"), F.when(z, div(d("service"), d("hours"))).otherwise(d("pph_stated")).alias("pph"), F.when(z, div(d("asked"), d("guests"))).otherwise(d("request_stated")).alias("req_pct"), F.when(z, 0.0).otherwise(d("minutes")).alias("avg_service_time_min"))


def strict(value: Column, text: Column, what: str) -> Column:
    """value, or an error where there is text but no value: for readers that must not go on."""
    return F.when(value.isNotNull() | (F.coalesce(F.trim(text), F.lit("")) == ""), value).otherwise(F.raise_error(F.concat(F.lit(f"not {what}: "), text)).cast(MONEY))


MONEY = facts.MONEY


def urgency(text: Column) -> Column:
    """How soon a message wants an answer, by the words in it; the strongest counts."""
    t = F.lower(text)
    return F.when(t.rlike(r"\b(urgent|asap|immediately|today)\b"), "high").when(t.rlike(r"\b(soon|tomorrow|week)\b"), "medium").otherwise("low")


def _docs(spark, sf_dir) -> DataFrame:
    """A document a location and month with figures, categories and employees; a blank name and an artifact are in each."""
    m = facts.totals(facts.lines(spark, sf_dir).withColumn("year_month", facts.year_month(F.col("week_ending"))), ["stylist_name", "loc_name", "platform", "year_month"])
    e = F.struct(F.col("stylist_name").alias("name"), F.col("guests").cast("long").alias("guests"), "service", "product", F.col("prod_hours").alias("hours"), F.col("wax_count").alias("asked"), F.lit(0.25).alias("request_stated"), F.lit(12.5).alias("ticket_stated"), F.lit(50.0).alias("pph_stated"), F.lit(30.0).alias("minutes"))
    named = lambda n: F.transform(F.slice(F.collect_list(e), 1, 1), lambda x: x.withField("name", F.lit(n)))
    cats = F.create_map(F.lit("wax"), F.struct(F.sum("wax_count").alias("qty"), F.sum("wax").alias("sales")), F.lit("color"), F.struct(F.count("*").alias("qty"), F.sum("color").alias("sales")))
    figures = F.struct(F.sum("guests").alias("guests"), F.sum("service").alias("service"), F.sum("product").alias("product"))
    return m.groupBy(*KEYS, "platform").agg(figures.alias("figures"), cats.alias("categories"), F.concat(F.collect_list(e), named(" "), named("House _")).alias("employees"))


def _locations(spark, sf_dir) -> DataFrame:
    p = facts.places(spark, sf_dir).select("loc_name", "loc_id", "platform").distinct()
    return p.select(F.when(F.col("loc_id") % 3 == 0, F.concat("loc_name", F.lit(" FS"))).otherwise(F.col("loc_name")).alias("name"), "platform", F.col("loc_id").cast("long").alias("id"))


def location_aliases(spark, sf_dir):
    return location_lookup(_locations(spark, sf_dir))


def bare_file_names(spark, sf_dir):
    """Files by bare names and the locations they are of."""
    files = facts.places(spark, sf_dir).select(F.concat("loc_name", F.lit(".pdf")).alias("file")).distinct()
    return files.join(location_lookup(_locations(spark, sf_dir)), F.lower(F.regexp_replace("file", r"\.pdf$", "")) == F.col("alias")).select("file", "name", "id")


def current_rows(spark, sf_dir):
    return current_row(_docs(spark, sf_dir))


def stylist_rows(spark, sf_dir):
    return kpi.plain(employee_rows(_docs(spark, sf_dir)), [*KEYS, "platform", "name", "guests", "service", "product", "hours"])


def monthly_staff_rows(spark, sf_dir):
    return monthly_staff(employee_rows(_docs(spark, sf_dir)))


def monthly_rows(spark, sf_dir):
    """A document's monthly row: period, figures as stated, ratios from them, and where it is from."""
    first = F.to_date(F.concat("year_month", F.lit("-01")))
    r = current_row(_docs(spark, sf_dir))
    return r.select(*KEYS, first.alias("period_start"), F.last_day(first).alias("period_end"), "guests", "total_sales", kpi.ratio(F.col("total_sales"), F.col("guests")).alias("avg_ticket"), kpi.ratio(F.col("product"), F.col("guests")).alias("ppg"), F.lit("monthly_pdf").alias("source"))


def staff_patches(spark, sf_dir):
    """Patches for later columns: each employee's request share and service time, by month, name and place."""
    return monthly_staff(employee_rows(_docs(spark, sf_dir))).select("year_month", "name", "loc_name", "req_pct", "avg_service_time_min")


def patched_rows(spark, sf_dir):
    """Monthly staff rows without those columns, and every fourth location's not at all, after the patches: rows that are there get them."""
    from tallyloom.operators.ledger import patch

    m = monthly_staff(employee_rows(_docs(spark, sf_dir)))
    rows = m.where("NOT loc_name LIKE '%4'").select("year_month", "name", "loc_name", F.lit(None).cast("double").alias("req_pct"), F.lit(None).cast("double").alias("avg_service_time_min"))
    return patch(rows, staff_patches(spark, sf_dir), ["year_month", "name", "loc_name"], ["req_pct", "avg_service_time_min"])


def patches(spark, sf_dir):
    """What later columns need from a document: request shares and times of its employees, and a rebooking share, which is the share of those asked for."""
    s = monthly_staff(employee_rows(_docs(spark, sf_dir)))
    return s.groupBy(*KEYS).agg(F.count("*").alias("n_patches"), F.count_if(F.col("req_pct") > 0).alias("n_requests"), F.max("avg_service_time_min").alias("longest"))


def json_lines_scan(spark, sf_dir):
    """Objects written one to a line, with broken lines between them, and read back."""
    path = f"{work_folder(spark)}/lines"
    p = facts.places(spark, sf_dir)
    good = p.select(F.to_json(F.struct("s_suppkey", "loc_name")).alias("value"))
    good.unionByName(p.select(F.concat(F.lit("{broken "), "stylist_name").alias("value"))).write.text(path)
    return json_lines(spark, path, "s_suppkey bigint, loc_name string")


def delimited_scan(spark, sf_dir):
    """Rows under a header, some too short, some with bad numbers."""
    path = f"{work_folder(spark)}/rows"
    p = facts.places(spark, sf_dir).withColumn("k", F.col("s_suppkey") % 3)
    line = F.when(F.col("k") == 0, F.col("stylist_name")).when(F.col("k") == 1, F.concat_ws(",", "stylist_name", F.lit("n/a"), "loc_name")).otherwise(F.concat_ws(",", "stylist_name", "s_suppkey", "loc_name"))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) == 0  # of a partition, which is a file
    p.select(F.when(first, F.concat(F.lit("name,number,place\n"), line)).otherwise(line).alias("value")).write.text(path)
    return delimited(spark, path, "name string, number bigint, place string")


def _report_folder(spark, sf_dir) -> str:
    """Texts as files of .../<bucket>/<month's first day>/<location>.txt, one a location and month."""
    path = f"{work_folder(spark)}/reports"
    t = summary_texts(spark, sf_dir)
    t.select(F.lit("in").alias("bucket"), F.concat("year_month", F.lit("-01")).alias("week"), F.col("loc_name").alias("place"), F.col("text").alias("value")).repartition("week", "place").write.partitionBy("bucket", "week", "place").text(path, lineSep="\x01")
    return path


def report_file_rows(spark, sf_dir):
    """Report files below a folder: where and when they are from, read from their paths, the hash of their bytes, and the totals they state."""
    files = report_files(spark, _report_folder(spark, sf_dir), ("txt",))
    part = lambda k: F.regexp_extract("path", rf"{k}=([^/]+)", 1)
    text = F.regexp_replace("text", "\x01$", "")
    return files.select(part("place").alias("loc_name"), F.substring(part("week"), 1, 7).alias("year_month"), F.sha2(text.cast("binary"), 256).alias("sha256"), parsing.figures(text, "Service Net").cast("double").alias("service"))


def report_source(spark, sf_dir):
    """The same by the data source, month by month of the path: what a filter on the week leaves is all that is opened."""
    folder = _report_folder(spark, sf_dir)
    text = F.regexp_replace("text", "\x01$", "")

    def part(condition: str) -> DataFrame:
        files = reports(spark, folder).where(condition)  # each part from a source of its own, see there
        return files.select(F.col("location").alias("loc_name"), F.date_format("week_ending", "yyyy-MM").alias("year_month"), F.sha2(text.cast("binary"), 256).alias("sha256"), parsing.figures(text, "Service Net").cast("double").alias("service"))

    return part("week_ending < DATE '1995-01-01'").unionByName(part("week_ending >= DATE '1995-01-01'"))


def report_batch(spark, sf_dir):
    """A folder of monthly reports read, its people and locations made into rows, by outcome: what a batch run says in the end."""
    files = report_files(spark, _report_folder(spark, sf_dir), ("txt",))
    part = lambda k: F.regexp_extract("path", rf"{k}=([^/]+)", 1)
    docs = files.select(part("place").alias("loc_name"), F.substring(part("week"), 1, 7).alias("year_month"), F.regexp_replace("text", "\x01$", "").alias("text"))
    s = sales_and_hours(docs, KEYS)
    return s.groupBy("year_month").agg(F.count_distinct("loc_name").alias("n_locations"), F.count("*").alias("n_people"), F.count("flag").alias("n_flags"), F.sum("service").cast("double").alias("service"))


def message_urgency(spark, sf_dir):
    """Urgency of the words of orders' statuses and priorities, written as messages."""
    from tallyloom.sources.tables import parquet

    o = parquet(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, "Please answer TODAY, or next week").when(k == 1, "see you tomorrow").when(k == 2, "weekly todays").otherwise("")
    return o.select("o_orderkey", urgency(text).alias("urgency"))


QUERIES = {
    f.__name__: f
    for f in (location_aliases, bare_file_names, current_rows, stylist_rows, monthly_staff_rows, monthly_rows, staff_patches, patched_rows, patches, json_lines_scan, delimited_scan, report_file_rows, report_source, report_batch, message_urgency)
}

_ST = f"""{facts.LINES_SQL},
st AS ({facts.totals_sql("stylist_name, loc_name, platform, year_month", rows="(SELECT *, strftime(week_ending, '%Y-%m') AS year_month FROM lines)")}),
dc AS (SELECT loc_name, year_month, platform, sum(guests)::DOUBLE AS g, sum(service)::DOUBLE AS s, sum(product)::DOUBLE AS p, sum(wax_count)::DOUBLE AS wq, sum(wax)::DOUBLE AS w, sum(color)::DOUBLE AS c FROM st GROUP BY 1, 2, 3),
cr AS (SELECT *, {kpi.rounded_sql("s + p", 2)} AS t, {kpi.rounded_sql("s", 2)} AS s2, {kpi.rounded_sql("p", 2)} AS p2 FROM dc),
lc AS (SELECT DISTINCT loc_name, loc_id, platform, loc_name || CASE WHEN loc_id % 3 = 0 THEN ' FS' ELSE '' END AS name FROM places)"""
_LIVE = "service > 0 OR product > 0 OR prod_hours > 0"
_STAFF = f"""ms AS (SELECT loc_name, year_month, platform, stylist_name AS name, guests::DOUBLE AS guests, CASE WHEN platform = 'zenoti' THEN coalesce((service::DOUBLE + product::DOUBLE) / nullif(guests, 0), 0) ELSE 12.5 END AS avg_ticket,
  CASE WHEN platform = 'zenoti' THEN coalesce(service::DOUBLE / nullif(prod_hours::DOUBLE, 0), 0) ELSE 50.0 END AS pph, CASE WHEN platform = 'zenoti' THEN coalesce(wax_count::DOUBLE / nullif(guests, 0), 0) ELSE 0.25 END AS req_pct,
  CASE WHEN platform = 'zenoti' THEN 0.0 ELSE 30.0 END AS avg_service_time_min FROM st WHERE {_LIVE})"""


def _summary() -> str:
    from tallyloom.operators.summaries import ORACLE

    return ORACLE["sale_and_hours_tables"]


def _file_sql() -> str:
    """The texts of the files, written by the database."""
    from tallyloom.operators.summaries import _STAFF as staff

    money = lambda c: f"format('{{:t,.2f}}', ({c})::DOUBLE)".replace("t,", ",")
    return f"""WITH {staff}, k AS (SELECT loc_name, year_month, loc_id, string_agg(CASE WHEN sold THEN name || chr(10) || {money("service")} || ' (12.5%) ' || {money("tips")} || ' ' || guests || chr(10) || guests || ' 0.00 -1.00 ' || {money("product")} ELSE '' END, chr(10) ORDER BY stylist_name) AS sale,
  string_agg(CASE WHEN timed THEN replace(name, ' ', chr(10)) || chr(10) || '1' || chr(10) || '2' || chr(10) || '3' || chr(10) || {money("hours")} || chr(10) || '5' ELSE '' END, chr(10) ORDER BY stylist_name) AS perf,
  coalesce(sum(service) FILTER (sold), 0) + CASE WHEN year_month LIKE '%-03' THEN 5 ELSE 0 END AS s, coalesce(sum(product) FILTER (sold), 0) AS p, coalesce(sum(tips) FILTER (sold), 0) AS t, coalesce(sum(hours) FILTER (timed), 0) AS h FROM sn GROUP BY 1, 2, 3)
SELECT loc_name, year_month, sha256('Center 888-' || (loc_id + 100) || '-' || loc_name || chr(10) || 'Service Net: ' || {money("s")} || chr(10) || 'Product Net: ' || {money("p")} || chr(10) || 'TIPS COLLECTED AMOUNT' || chr(10) || 'Cash 1.00' || chr(10) || 'Total ' || {money("t")} || chr(10)
  || 'EMPLOYEE SALE DETAILS' || chr(10) || sale || chr(10) || 'STYLIST' || chr(10) || '9 9 9 9 9 9 9 9' || chr(10) || 'EMPLOYEE PERFORMANCE' || chr(10) || perf || chr(10) || 'Total 1 2 3 ' || {money("h")}) AS sha256, s::DOUBLE AS service FROM k"""


ORACLE = {
    "location_aliases": f"WITH {_ST} SELECT lower(name) AS alias, name, platform, loc_id AS id FROM lc UNION SELECT lower(loc_name), name, platform, loc_id FROM lc",
    "bare_file_names": f"WITH {_ST} SELECT loc_name || '.pdf' AS file, name, loc_id AS id FROM lc",
    "current_rows": f"""WITH {_ST} SELECT loc_name, year_month, platform, g AS guests, t AS total_sales, s2 AS service, p2 AS product, coalesce({kpi.rounded_sql("p / nullif(t, 0)", 4)}, 0.0) AS product_pct, wq AS wax_count, w AS wax, coalesce({kpi.rounded_sql("c / nullif(s, 0)", 4)}, 0.0) AS color_pct FROM cr""",
    "stylist_rows": f"WITH {_ST} SELECT loc_name, year_month, platform, stylist_name AS name, guests, service::DOUBLE AS service, product::DOUBLE AS product, prod_hours::DOUBLE AS hours FROM st WHERE {_LIVE}",
    "monthly_staff_rows": f"WITH {_ST}, {_STAFF} SELECT * FROM ms",
    "monthly_rows": f"""WITH {_ST}, f AS (SELECT *, (year_month || '-01')::DATE AS first FROM cr) SELECT loc_name, year_month, first AS period_start, last_day(first) AS period_end, g AS guests, t AS total_sales, coalesce(t / nullif(g, 0), 0) AS avg_ticket, coalesce(p2 / nullif(g, 0), 0) AS ppg, 'monthly_pdf' AS source FROM f""",
    "patches": f"WITH {_ST}, {_STAFF} SELECT loc_name, year_month, count(*) AS n_patches, count(*) FILTER (req_pct > 0) AS n_requests, max(avg_service_time_min)::DOUBLE AS longest FROM ms GROUP BY 1, 2",
    "json_lines_scan": "SELECT s_suppkey, n_name AS loc_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "delimited_scan": "SELECT s_name AS name, CASE WHEN s_suppkey % 3 = 2 THEN s_suppkey END AS number, CASE WHEN s_suppkey % 3 > 0 THEN n_name END AS place FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "report_file_rows": _file_sql(),
    "report_batch": f"SELECT year_month, count(DISTINCT loc_name) AS n_locations, count(*) AS n_people, count(flag) AS n_flags, sum(service::DECIMAL(18,2))::DOUBLE AS service FROM ({_summary()}) GROUP BY 1",
    "message_urgency": "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS urgency FROM orders",
}
ORACLE["report_source"] = ORACLE["report_file_rows"]
_PATCH = "SELECT year_month, name, loc_name, req_pct, avg_service_time_min"
ORACLE["staff_patches"] = f"{_PATCH} FROM ({ORACLE['monthly_staff_rows']})"
ORACLE["patched_rows"] = f"{_PATCH} FROM ({ORACLE['monthly_staff_rows']}) WHERE loc_name NOT LIKE '%4'"
