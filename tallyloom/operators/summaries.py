"""Report texts of one location and period: their sections, the people in them, what they must add up to, and rows made of them.

Texts are read as tokens: a run of words followed by a run of numbers, wherever lines break. All is windows over the tokens of one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import kpi, parsing
from tallyloom.operators.coverage import is_role
from tallyloom.sources import facts
from tallyloom.sources.tables import parquet
from tallyloom.sources.work import tasks

MONEY = facts.MONEY
DOC = ["loc_name", "year_month"]
NUMBER = r"^\(?-?\$?[\d,]+(\.\d+)?\)?%?$"
# Names of rows that are no person, whole and in part.
ARTIFACTS, ARTIFACT_PARTS = ("all", "house sale", "house _", "booked online", "salon ultimate"), (" mgr", "unknown", "house ")
#: Largest gap of two sums that should agree.
CENT = 0.01
#: The 18 columns that staff rows of every system have.
STAFF = ["year_month", "name", "loc_name", "loc_id", "platform", "invoices", "guests", "net_service", "net_product", "avg_ticket", "pph", "ppg", "production_hours", "source", "period_start", "period_end", "req_pct", "avg_service_time_min"]


def section(text: Column, begin: str, end: str | None = None) -> Column:
    """What stands between two headings; empty without the first, and up to the end without the second."""
    stop = rf"(?:{end}|\z)" if end else r"\z"
    return F.regexp_extract(text, rf"(?is){begin}(.*?){stop}", 1)


def unwrap_numbers(text: Column) -> Column:
    """A number that a line break cut after its first decimal is one again."""
    return F.regexp_replace(text, r"(\d\.\d)\r?\n(\d)(?!\d)", "$1$2")


def token_rows(docs: DataFrame, keys: list[str], text: Column, least: int, words: int = 3) -> DataFrame:
    """(keys, place, name, numbers): for each run of `least` numbers at least, the last `words` words before it. Percents in brackets are left out."""
    tokens = F.filter(F.split(text, r"[|\s]+"), lambda x: (x != "") & ~x.rlike(r"^\(\d+(\.\d+)?%?\)$"))
    t = docs.select(*keys, F.posexplode(tokens).alias("pos", "token")).withColumn("number", F.col("token").rlike(NUMBER))
    w = Window.partitionBy(*keys).orderBy("pos")
    new = F.coalesce((F.col("number") != F.lag("number").over(w)).cast("int"), F.lit(1))
    t = t.withColumn("run", F.sum(new).over(w))
    runs = t.groupBy(*keys, "run", "number").agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("x"))
    runs = runs.withColumn("x", F.transform("x", lambda s: s["token"])).withColumn("before", F.lag("x").over(Window.partitionBy(*keys).orderBy("run")))
    rows = runs.where(F.col("number") & (F.size("x") >= least) & F.col("before").isNotNull())
    name = F.array_join(F.slice("before", F.greatest(F.lit(1), F.size("before") - words + 1), F.lit(words)), " ")
    return rows.select(*keys, F.col("run").alias("place"), name.alias("name"), F.transform("x", parsing.money).alias("numbers"))


def is_artifact(name: Column) -> Column:
    n = F.lower(F.regexp_replace(F.trim(name), r"\s+", " "))
    part = F.lit(False)
    for p in ARTIFACT_PARTS:
        part = part | n.contains(p)
    return n.isin(*ARTIFACTS) | part


def people_of(docs: DataFrame, keys: list[str], text: Column, least: int) -> DataFrame:
    """token_rows of persons: two words at least, the first with a capital, and no role."""
    return token_rows(docs, keys, text, least).where(F.col("name").rlike(r"^\p{Lu}\S* \S") & ~is_role(F.col("name")))


def sales_and_hours(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, name, service, tips, qty, invoices, product, hours, flag) of the two tables of a text, joined by name; flag says who is in one only.

    Of several people of one name the first of one table is the first of the other, and so on: each row counts once.
    """
    n = lambda i: F.get("numbers", F.lit(i))
    nth = F.row_number().over(Window.partitionBy(*keys, "name").orderBy("place")).alias("_nth")
    sale = people_of(docs, keys, section(F.col(text), "EMPLOYEE SALE DETAILS", "EMPLOYEE PERFORMANCE"), 7)
    sale = sale.select(*keys, "name", nth, n(0).alias("service"), n(1).alias("tips"), n(2).cast("long").alias("qty"), n(3).cast("long").alias("invoices"), n(6).alias("product"), F.lit(True).alias("_sale"))
    hours = people_of(docs, keys, section(F.col(text), "EMPLOYEE PERFORMANCE"), 4).select(*keys, "name", nth, n(3).alias("hours"), F.lit(True).alias("_hours"))
    out = sale.join(hours, [*keys, "name", "_nth"], "full").drop("_nth")
    return out.withColumn("flag", F.when(F.col("_hours").isNull(), "sale_without_hours").when(F.col("_sale").isNull(), "hours_without_sale")).drop("_sale", "_hours")


def labelled(text: Column, label: str) -> Column:
    return parsing.figures(text, label)


def tips_total(text: Column) -> Column:
    """The first Total within 400 characters of the heading."""
    part = F.regexp_extract(text, r"(?is)(TIPS COLLECTED.{0,386})", 1)
    return parsing.money(F.nullif(F.regexp_extract(part, r"Total\s+(-?[\d,]+\.\d+)", 1), F.lit("")))


def legs(docs: DataFrame, staff: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, leg, stated, summed, gap, ok): what a text states of service, product, tips and hours against the sums over all its rows."""
    sums = staff.groupBy(*keys).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("service", "product", "tips", "hours")))
    t = F.col("text")
    hours = F.get(parsing.person_numbers(section(t, "EMPLOYEE PERFORMANCE"), "Total"), F.lit(3))
    stated = docs.select(*keys, labelled(t, "Service Net").alias("s"), labelled(t, "Product Net").alias("p"), tips_total(t).alias("t"), hours.alias("h"))
    both = stated.join(sums, keys, "left")
    row = lambda leg, a, b: F.struct(F.lit(leg).alias("leg"), F.col(a).cast("double").alias("stated"), F.coalesce(b, F.lit(0)).cast("double").alias("summed"))
    out = both.select(*keys, F.inline(F.array(row("SERVICE", "s", "service"), row("PRODUCT", "p", "product"), row("TIPS", "t", "tips"), row("HOURS", "h", "hours"))))
    gap = F.round(F.col("stated") - F.col("summed"), 2)
    return out.withColumn("gap", gap).withColumn("ok", F.coalesce(F.abs(gap) <= CENT, F.lit(False)))


def staff_rows(staff: DataFrame, source: str) -> DataFrame:
    """Rows of the 18 columns for those who worked, artifacts aside: guests are invoices, figures are rounded and never null."""
    s, h = F.coalesce("service", F.lit(0)).cast("double"), F.coalesce("hours", F.lit(0)).cast("double")
    p, g = F.coalesce("product", F.lit(0)).cast("double"), F.coalesce("invoices", F.lit(0))
    first = F.to_date(F.concat("year_month", F.lit("-01")))
    div = lambda a, b: F.coalesce(kpi.rounded(F.try_divide(a, b.cast("double")), 2), F.lit(0.0))
    made = {
        "invoices": g, "guests": g, "net_service": F.round(s, 2), "net_product": F.round(p, 2), "avg_ticket": div(s + p, g), "pph": div(s, h), "ppg": div(p, g),
        "production_hours": F.round(h, 2), "source": F.lit(source), "period_start": first, "period_end": F.last_day(first), "req_pct": F.lit(0.0), "avg_service_time_min": F.lit(0.0),
    }
    return staff.where(~is_artifact(F.col("name")) & ((s > 0) | (h > 0))).withColumns(made).select(STAFF)


def raw_fields(docs: DataFrame, keys: list[str], labels: dict[str, str], text: str = "text") -> DataFrame:
    """docs' keys with a column for each labelled value, null where absent, and missing: the names of those, comma-joined."""
    out = docs.select(*keys, *(labelled(F.col(text), label).alias(name) for name, label in labels.items()))
    return out.withColumn("missing", F.array_join(F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in labels))), ","))


def categories(docs: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """(keys, wax_qty, wax_sales, color_qty, ...): label lines with a count, a sum and a share after them; waxing counts as wax."""
    rows = token_rows(docs, keys, text, 3, words=1).withColumn("label", F.lower("name"))
    rows = rows.withColumn("label", F.when(F.col("label") == "waxing", "wax").otherwise(F.col("label")))
    of = lambda c, i: F.coalesce(F.sum(F.when(F.col("label") == c, F.get("numbers", F.lit(i)))), F.lit(0).cast(MONEY))
    return rows.groupBy(*keys).agg(*(x for c in ("wax", "color", "treatment", "haircut") for x in (of(c, 0).cast("long").alias(f"{c}_qty"), of(c, 1).alias(f"{c}_sales"))))


def kpi_block(df: DataFrame, recomputed: bool = True) -> DataFrame:
    """df(service, product, total, guests, hours, pph_stated, categories) with the figures reports show and the flags of what disagrees.

    recomputed: productivity is service an hour; else the stated one is passed on.
    """
    c = lambda x: F.col(x).cast("double")
    div = lambda a, b, n: F.when(b > 0, kpi.rounded(a / b, n))
    total = F.round(c("service") + c("product"), 2)
    out = df.withColumns({"total_sales": total, "avg_ticket": div(total, c("guests"), 2), "ppg": div(c("product"), c("guests"), 4)})
    out = out.withColumns({"pph": div(c("service"), c("hours"), 2) if recomputed else c("pph_stated"), "wax_pct": div(c("wax_qty"), c("guests"), 4), "treatment_pct": div(c("treatment_qty"), c("guests"), 4), "color_pct": div(c("color_sales"), c("service"), 4)})
    flags = [F.when(F.abs(c("total") - total) > CENT, F.lit("TOTAL_SALES_MISMATCH"))]
    if not recomputed:
        flags += [F.when(c("guests_stated") != c("guests"), F.lit("GUEST_COUNT_MISMATCH")), F.when(F.abs(c("lines_stated") - c("product")) > CENT, F.lit("PRODUCT_TOTAL_MISMATCH"))]
    return out.withColumn("flags", F.array_join(F.array_compact(F.array(*flags)), ","))


def role_tags(lines: DataFrame, keys: list[str], line: str) -> DataFrame:
    """lines(keys, place, line) with role: the last line above that is nothing but a role."""
    w = Window.partitionBy(*keys).orderBy("place")
    alone = F.when(F.col(line).rlike(r"^\s*(MANAGER|SHIFT LEADER|STYLIST)\s*$"), F.trim(line))
    return lines.withColumn("role", F.last(alone, ignorenulls=True).over(w)).where(alone.isNull())


# Queries: texts are written from the order tables and read again.


def _staff(spark, sf_dir) -> DataFrame:
    """A row a person and month. Every seventh person has no hours, every eleventh no sales; two rows a location are no persons."""
    m = facts.totals(facts.lines(spark, sf_dir).withColumn("year_month", facts.year_month(F.col("week_ending"))), ["stylist_name", "loc_name", "loc_id", "platform", "year_month"])
    h = F.translate(F.md5(F.col("stylist_name").cast("binary")), "0123456789", "ghijklmnop")
    k = F.regexp_extract("stylist_name", r"(\d+)", 1).cast("int")
    name = F.when(k % 5 == 3, F.concat(F.initcap(F.substring(h, 1, 6)), F.lit(" Mgr mgr"))).otherwise(F.initcap(F.concat_ws(" ", F.substring(h, 1, 6), F.substring(h, 7, 8))))
    return m.select("stylist_name", name.alias("name"), k.alias("k"), *DOC, "loc_id", "platform", "guests", "service", "product", F.col("treat").alias("tips"), F.col("prod_hours").alias("hours"), "wax_count", "wax", "color", "treat_count", "treat")


def _money(c: Column) -> Column:
    return F.format_number(c, 2)


def _texts(spark, sf_dir) -> DataFrame:
    """(loc_name, year_month, loc_id, text). A text's rows come together in tasks of a bounded number of lines, where it is read as well."""
    s = _staff(spark, sf_dir).repartition(tasks(parquet(spark, sf_dir, "lineitem"), facts.LINES), *DOC)
    has_sale, has_hours = F.col("k") % 11 != 0, F.col("k") % 7 != 0
    sale = F.when(has_sale, F.concat_ws("\n", "name", F.concat_ws(" ", _money(F.col("service")), F.concat(F.lit("("), F.lit("12.5"), F.lit("%)")), _money(F.col("tips")), F.col("guests")), F.concat_ws(" ", F.col("guests"), F.lit("0.00"), F.lit("-1.00"), _money(F.col("product")))))
    perf = F.when(has_hours, F.concat_ws("\n", F.regexp_replace("name", " ", "\n"), F.concat_ws("\n", F.lit("1"), F.lit("2"), F.lit("3"), _money(F.col("hours")), F.lit("5"))))
    lines = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("stylist_name", c.alias("t")))), lambda x: x["t"]), "\n")
    kept = lambda c, on: F.coalesce(F.sum(F.when(on, F.col(c))), F.lit(0).cast(MONEY))
    g = s.groupBy(*DOC, "loc_id").agg(lines(F.coalesce(sale, F.lit(""))).alias("sale"), lines(F.coalesce(perf, F.lit(""))).alias("perf"), kept("service", has_sale).alias("s"), kept("product", has_sale).alias("p"), kept("tips", has_sale).alias("t"), kept("hours", has_hours).alias("h"))
    off = F.when(F.col("year_month").endswith("-03"), 5).otherwise(0).cast(MONEY)
    head = [F.concat(F.lit("Center 888-"), (F.col("loc_id") + 100).cast("string"), F.lit("-"), F.col("loc_name")), F.concat(F.lit("Service Net: "), _money(F.col("s") + off)), F.concat(F.lit("Product Net: "), _money(F.col("p")))]
    tips = [F.lit("TIPS COLLECTED AMOUNT"), F.lit("Cash 1.00"), F.concat(F.lit("Total "), _money(F.col("t")))]
    text = F.concat_ws("\n", *head, *tips, F.lit("EMPLOYEE SALE DETAILS"), "sale", F.lit("STYLIST"), F.lit("9 9 9 9 9 9 9 9"), F.lit("EMPLOYEE PERFORMANCE"), "perf", F.concat(F.lit("Total 1 2 3 "), _money(F.col("h"))))
    return g.select(*DOC, "loc_id", text.alias("text"))


def _joined(spark, sf_dir) -> DataFrame:
    return sales_and_hours(_texts(spark, sf_dir), [*DOC, "loc_id"])


def sale_and_hours_tables(spark, sf_dir):
    return kpi.plain(_joined(spark, sf_dir), [*DOC, "name", "service", "tips", "qty", "invoices", "product", "hours", "flag"])


def summary_legs(spark, sf_dir):
    t = _texts(spark, sf_dir)
    return legs(t, sales_and_hours(t, DOC), DOC)


def summary_verdict(spark, sf_dir):
    """A text reconciles if all four legs do; strict reading drops the others."""
    x = summary_legs(spark, sf_dir).groupBy(*DOC).agg(F.count_if(~F.col("ok")).alias("n_bad"), F.array_join(F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col("leg")))), ",").alias("problems"))
    return x.withColumn("reconciled", F.col("n_bad") == 0)


def staff_contract(spark, sf_dir):
    return staff_rows(_joined(spark, sf_dir).withColumn("platform", F.lit("zenoti")), "summary")


def active_and_artifacts(spark, sf_dir):
    """How many rows of a text are persons who worked, artifacts, and neither."""
    s = _joined(spark, sf_dir)
    worked = (F.coalesce("service", F.lit(0)) > 0) | (F.coalesce("hours", F.lit(0)) > 0)
    a = is_artifact(F.col("name"))
    return s.groupBy(*DOC).agg(F.count_if(worked & ~a).alias("n_active"), F.count_if(a).alias("n_artifacts"), F.count_if(~worked & ~a).alias("n_idle"))


def center_location(spark, sf_dir):
    """The location that a text's center names, by a crosswalk that lacks every fourth; the raw center stays."""
    raw = F.trim(F.regexp_extract("text", r"(\d{3}-\d{3,6}-[^\n]+)", 1))
    known = facts.places(spark, sf_dir).where("loc_id % 4 <> 0").select("loc_id", "loc_name").distinct().select(F.concat(F.lit("888-"), (F.col("loc_id") + 100).cast("string"), F.lit("-"), F.col("loc_name")).alias("center"), F.col("loc_id").cast("long").alias("location_id"), F.col("loc_name").alias("canonical"))
    return _texts(spark, sf_dir).select(*DOC, raw.alias("center")).join(known, "center", "left")


def tips_collected(spark, sf_dir):
    return _texts(spark, sf_dir).select(*DOC, tips_total(F.col("text")).cast("double").alias("tips"))


def wrapped_numbers(spark, sf_dir):
    """Balances cut after the first decimal by a line break."""
    c = parquet(spark, sf_dir, "customer").select("c_custkey", F.regexp_replace(F.format_number(F.abs("c_acctbal"), 2), r"(\.\d)(\d)$", "$1\n$2").alias("t"))
    return c.select("c_custkey", parsing.money(unwrap_numbers(F.col("t"))).cast("double").alias("amount"))


def _blocks(spark, sf_dir) -> DataFrame:
    """Texts with labelled values and category blocks. Hours are missing in every January, total and guests are off in some months."""
    s = _staff(spark, sf_dir)
    g = s.groupBy(*DOC, "platform").agg(*(F.sum(c).alias(c) for c in ("guests", "service", "product", "hours", "wax_count", "wax", "color", "treat_count", "treat")))
    m = F.substring("year_month", 6, 2).cast("int")
    off = F.when(m == 5, 1).otherwise(0)
    one = lambda label, q, v: F.concat(F.lit(label + "\n"), q.cast("string"), F.lit("\n"), _money(v), F.lit("\n1.0"))
    lines = [
        F.concat(F.lit("Service Total: $"), _money(F.col("service"))), F.concat(F.lit("Retail Total: $"), _money(F.col("product"))), F.concat(F.lit("Revenue: $"), _money(F.col("service") + F.col("product") + off)),
        F.concat(F.lit("Serviced Guests: "), (F.col("guests") - F.col("guests") % 3).cast("string")), F.concat(F.lit("Retail Guests: "), (F.col("guests") % 3).cast("string")), F.concat(F.lit("All Guests: "), (F.col("guests") + F.when(m == 6, 2).otherwise(0)).cast("string")),
        F.when(m != 1, F.concat(F.lit("Hours: "), _money(F.col("hours")))), F.lit("Productivity: 12.34"), F.concat(F.lit("Lines Total: $"), _money(F.col("product") + F.when(m == 7, 3).otherwise(0))),
        F.lit("CATEGORIES"), one("Wax", F.col("wax_count"), F.col("wax")), one("Waxing", F.lit(2), F.lit(10).cast(MONEY)), one("Color", F.lit(1), F.col("color")), one("Treatment", F.col("treat_count"), F.col("treat")), F.lit("END"),
    ]
    return g.select(*DOC, "platform", F.concat_ws("\n", *lines).alias("text"))


LABELS = {"service": "Service Total", "product": "Retail Total", "total": "Revenue", "serviced": "Serviced Guests", "retail_only": "Retail Guests", "guests_stated": "All Guests", "hours": "Hours", "pph_stated": "Productivity", "lines_stated": "Lines Total"}


def raw_report_fields(spark, sf_dir):
    return kpi.plain(raw_fields(_blocks(spark, sf_dir), DOC, LABELS), [*DOC, *LABELS, "missing"])


def report_categories(spark, sf_dir):
    out = categories(_blocks(spark, sf_dir), DOC, section(F.col("text"), "CATEGORIES", "END"))
    return kpi.plain(out, out.columns)


def _figures(spark, sf_dir) -> DataFrame:
    t = _blocks(spark, sf_dir)
    rows = raw_fields(t, [*DOC, "platform"], LABELS).join(categories(t, DOC, section(F.col("text"), "CATEGORIES", "END")), DOC)
    return rows.withColumn("guests", F.col("serviced") + F.coalesce("retail_only", F.lit(0)))


SHOWN = [*DOC, "total_sales", "avg_ticket", "ppg", "pph", "wax_pct", "treatment_pct", "color_pct", "flags"]


def kpi_block_recomputed(spark, sf_dir):
    return kpi_block(_figures(spark, sf_dir).where("platform = 'zenoti'")).select(SHOWN)


def kpi_block_passed_on(spark, sf_dir):
    return kpi_block(_figures(spark, sf_dir).where("platform <> 'zenoti'"), recomputed=False).select(SHOWN)


def production_hours_total(spark, sf_dir):
    """The fourth number of the Total row."""
    t = _texts(spark, sf_dir)
    return t.select(*DOC, F.get(parsing.person_numbers(section(F.col("text"), "EMPLOYEE PERFORMANCE"), "Total"), F.lit(3)).cast("double").alias("hours"))


def role_tagged_rows(spark, sf_dir):
    """Names under role headings: the first third of a location's persons under one, the next under another."""
    w = Window.partitionBy(*DOC).orderBy("stylist_name")
    s = _staff(spark, sf_dir).withColumn("i", F.row_number().over(w))
    heads = s.where("i % 3 = 1").select(*DOC, (F.col("i") * 2 - 1).alias("place"), F.element_at(F.array(F.lit("MANAGER"), F.lit("STYLIST"), F.lit("SHIFT LEADER")), (F.floor(F.col("i") / 3) % 3 + 1).cast("int")).alias("line"))
    rows = heads.unionByName(s.select(*DOC, (F.col("i") * 2).alias("place"), F.col("stylist_name").alias("line")))
    return role_tags(rows, DOC, "line").select(*DOC, F.col("line").alias("stylist_name"), "role")


QUERIES = {
    f.__name__: f
    for f in (
        sale_and_hours_tables, summary_legs, summary_verdict, staff_contract, active_and_artifacts, center_location, tips_collected, wrapped_numbers, raw_report_fields, report_categories,
        kpi_block_recomputed, kpi_block_passed_on, production_hours_total, role_tagged_rows,
    )
}

_CAP = "upper(substr({x}, 1, 1)) || substr({x}, 2)"
_H = "translate(md5(stylist_name), '0123456789', 'ghijklmnop')"
_STAFF = f"""{facts.LINES_SQL},
st AS (SELECT stylist_name, loc_name, loc_id, platform, year_month, regexp_extract(stylist_name, '(\\d+)', 1)::INT AS k, guests, service, product, treat AS tips, prod_hours AS hours, wax_count, wax, color, treat_count, treat
  FROM ({facts.totals_sql("stylist_name, loc_name, loc_id, platform, year_month", rows="(SELECT *, strftime(week_ending, '%Y-%m') AS year_month FROM lines)")})),
sn AS (SELECT *, CASE WHEN k % 5 = 3 THEN {_CAP.format(x=f"substr({_H}, 1, 6)")} || ' Mgr mgr' ELSE {_CAP.format(x=f"substr({_H}, 1, 6)")} || ' ' || {_CAP.format(x=f"substr({_H}, 7, 8)")} END AS name, k % 11 <> 0 AS sold, k % 7 <> 0 AS timed FROM st),
sh AS (SELECT loc_name, year_month, loc_id, name, CASE WHEN sold THEN service END AS service, CASE WHEN sold THEN tips END AS tips, CASE WHEN sold THEN guests END AS qty, CASE WHEN sold THEN guests END AS invoices, CASE WHEN sold THEN product END AS product,
  CASE WHEN timed THEN hours END AS hours, CASE WHEN NOT timed THEN 'sale_without_hours' WHEN NOT sold THEN 'hours_without_sale' END AS flag FROM sn WHERE sold OR timed),
docs AS (SELECT DISTINCT loc_name, year_month, loc_id FROM st)"""
_LEGS = f"""{_STAFF},
sums AS (SELECT loc_name, year_month, coalesce(sum(service), 0)::DOUBLE AS s, coalesce(sum(product), 0)::DOUBLE AS p, coalesce(sum(tips), 0)::DOUBLE AS t, coalesce(sum(hours), 0)::DOUBLE AS h FROM docs LEFT JOIN sh USING (loc_name, year_month) GROUP BY 1, 2),
x AS (SELECT loc_name, year_month, unnest([{{'leg': 'SERVICE', 'a': s + CASE WHEN year_month LIKE '%-03' THEN 5 ELSE 0 END, 'b': s}}, {{'leg': 'PRODUCT', 'a': p, 'b': p}}, {{'leg': 'TIPS', 'a': t, 'b': t}}, {{'leg': 'HOURS', 'a': h, 'b': h}}]) AS l FROM sums),
legs AS (SELECT loc_name, year_month, l.leg AS leg, round(l.a, 2) AS stated, l.b AS summed, round(l.a - l.b, 2) AS gap, abs(round(l.a - l.b, 2)) <= 0.01::DOUBLE AS ok FROM x)"""
_R2 = f"coalesce({kpi.rounded_sql('({a})::DOUBLE / nullif(({b})::DOUBLE, 0)', 2)}, 0.0)"
_ZERO = "coalesce({c}, 0)::DOUBLE"
_FIG = f"""{_STAFF},
fg AS (SELECT loc_name, year_month, platform, substr(year_month, 6, 2)::INT AS m, sum(guests)::DOUBLE AS guests, sum(service)::DOUBLE AS service, sum(product)::DOUBLE AS product, (sum(service) + sum(product))::DOUBLE AS whole, sum(hours)::DOUBLE AS hours,
  (sum(wax_count) + 2)::DOUBLE AS wax_qty, (sum(wax) + 10)::DOUBLE AS wax_sales, sum(color)::DOUBLE AS color_sales, sum(treat_count)::DOUBLE AS treatment_qty, sum(treat)::DOUBLE AS treatment_sales FROM st GROUP BY 1, 2, 3)"""


def _shown(pph: str, flags: str, where: str) -> str:
    div = lambda a, b, n: f"CASE WHEN {b} > 0 THEN {kpi.rounded_sql(f'{a} / {b}', n)} END"
    return f"""WITH {_FIG} SELECT loc_name, year_month, round(whole, 2) AS total_sales, {div("round(whole, 2)", "guests", 2)} AS avg_ticket, {div("product", "guests", 4)} AS ppg, {pph} AS pph, {div("wax_qty", "guests", 4)} AS wax_pct,
  {div("treatment_qty", "guests", 4)} AS treatment_pct, {div("color_sales", "service", 4)} AS color_pct, concat_ws(',', {flags}) AS flags FROM fg WHERE {where}"""


ORACLE = {
    "sale_and_hours_tables": f"WITH {_STAFF} SELECT loc_name, year_month, name, service::DOUBLE AS service, tips::DOUBLE AS tips, qty, invoices, product::DOUBLE AS product, hours::DOUBLE AS hours, flag FROM sh",
    "summary_legs": f"WITH {_LEGS} SELECT * FROM legs",
    "summary_verdict": f"WITH {_LEGS} SELECT loc_name, year_month, count(*) FILTER (NOT ok) AS n_bad, coalesce(string_agg(leg, ',' ORDER BY leg) FILTER (NOT ok), '') AS problems, count(*) FILTER (NOT ok) = 0 AS reconciled FROM legs GROUP BY 1, 2",
    "staff_contract": f"""WITH {_STAFF}, z AS (SELECT *, {_ZERO.format(c="service")} AS s, {_ZERO.format(c="hours")} AS h, {_ZERO.format(c="product")} AS p, coalesce(invoices, 0) AS g, strptime(year_month || '-01', '%Y-%m-%d')::DATE AS first FROM sh)
SELECT year_month, name, loc_name, loc_id, 'zenoti' AS platform, g AS invoices, g AS guests, round(s, 2) AS net_service, round(p, 2) AS net_product, {_R2.format(a="s + p", b="g")} AS avg_ticket, {_R2.format(a="s", b="h")} AS pph, {_R2.format(a="p", b="g")} AS ppg,
  round(h, 2) AS production_hours, 'summary' AS source, first AS period_start, last_day(first) AS period_end, 0.0::DOUBLE AS req_pct, 0.0::DOUBLE AS avg_service_time_min FROM z WHERE name NOT LIKE '% mgr' AND (s > 0 OR h > 0)""",
    "active_and_artifacts": f"""WITH {_STAFF}, z AS (SELECT *, coalesce(service, 0) > 0 OR coalesce(hours, 0) > 0 AS worked, name LIKE '% mgr' AS a FROM sh)
SELECT loc_name, year_month, count(*) FILTER (worked AND NOT a) AS n_active, count(*) FILTER (a) AS n_artifacts, count(*) FILTER (NOT worked AND NOT a) AS n_idle FROM z GROUP BY 1, 2""",
    "center_location": f"""WITH {_STAFF} SELECT loc_name, year_month, '888-' || (loc_id + 100) || '-' || loc_name AS center, CASE WHEN loc_id % 4 <> 0 THEN loc_id END AS location_id, CASE WHEN loc_id % 4 <> 0 THEN loc_name END AS canonical FROM docs""",
    "tips_collected": f"WITH {_STAFF} SELECT loc_name, year_month, coalesce(sum(tips), 0)::DOUBLE AS tips FROM docs LEFT JOIN sh USING (loc_name, year_month) GROUP BY 1, 2",
    "wrapped_numbers": "SELECT c_custkey, abs(c_acctbal::DECIMAL(18,2))::DOUBLE AS amount FROM customer",
    "raw_report_fields": f"""WITH {_FIG} SELECT loc_name, year_month, service, product, round(whole + CASE WHEN m = 5 THEN 1 ELSE 0 END, 2) AS total, guests - guests % 3 AS serviced, guests % 3 AS retail_only, guests + CASE WHEN m = 6 THEN 2 ELSE 0 END AS guests_stated,
  CASE WHEN m <> 1 THEN hours END AS hours, 12.34::DOUBLE AS pph_stated, round(product + CASE WHEN m = 7 THEN 3 ELSE 0 END, 2) AS lines_stated, CASE WHEN m = 1 THEN 'hours' ELSE '' END AS missing FROM fg""",
    "report_categories": f"WITH {_FIG} SELECT loc_name, year_month, wax_qty, wax_sales, 1 AS color_qty, color_sales, treatment_qty, treatment_sales, 0 AS haircut_qty, 0.0::DOUBLE AS haircut_sales FROM fg",
    "kpi_block_recomputed": _shown("CASE WHEN m <> 1 AND hours > 0 THEN " + kpi.rounded_sql("service / hours", 2) + " END", "CASE WHEN m = 5 THEN 'TOTAL_SALES_MISMATCH' END", "platform = 'zenoti'"),
    "kpi_block_passed_on": _shown("12.34::DOUBLE", "CASE WHEN m = 5 THEN 'TOTAL_SALES_MISMATCH' END, CASE WHEN m = 6 THEN 'GUEST_COUNT_MISMATCH' END, CASE WHEN m = 7 THEN 'PRODUCT_TOTAL_MISMATCH' END", "platform <> 'zenoti'"),
    "production_hours_total": f"WITH {_STAFF} SELECT loc_name, year_month, coalesce(sum(hours), 0)::DOUBLE AS hours FROM docs LEFT JOIN sh USING (loc_name, year_month) GROUP BY 1, 2",
    "role_tagged_rows": f"""WITH {_STAFF}, r AS (SELECT *, row_number() OVER (PARTITION BY loc_name, year_month ORDER BY stylist_name) AS i FROM st)
SELECT loc_name, year_month, stylist_name, ['MANAGER', 'STYLIST', 'SHIFT LEADER'][((i - 1) // 3) % 3 + 1] AS role FROM r""",
}
