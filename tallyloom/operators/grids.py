"""Sheets as cells (sheet keys, r, c, v): header rows found by name, tables read under them, fixed blocks, and the rows made of them.

Cells compress to a small part of what they take in memory, so by the size of their files Spark would broadcast them whole: joins of cells are merge joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import kpi, parsing
from tallyloom.operators.summaries import CENT, STAFF, is_artifact
from tallyloom.sources import facts
from tallyloom.sources.work import stored, work_folder

MONEY = facts.MONEY
# Labels of the dashboard's first column and the fields beside them, and the names of categories in each bucket.
DASHBOARD = {"store name:": "store_name", "report period:": "period", "total service": "service", "total retail": "product", "total revenue": "revenue", "total guests": "guests", "tips": "tips", "production hours": "hours"}
BUCKETS = {"color": ("color", "colour"), "wax": ("wax", "waxing"), "treatment": ("treatment", "treatments")}
SHEET = ["loc_name", "year_month"]
# Column headers of the provider report and the fields they hold.
PROVIDER = {"provider name": "name", "service sales": "service", "retail sales": "product", "hours worked": "hours", "service clients": "clients", "req %": "req"}


def header_map(cells: DataFrame, keys: list[str], names: dict[str, str], first: str | None = None, row: int | None = None) -> DataFrame:
    """(keys, header_row, c, field): the first row whose first cell is `first`, or the given row, and the columns its labels name. The first of equal labels counts."""
    label = parsing.header(F.col("v"))
    if row is None:
        at = cells.where((F.col("c") == 0) & (label == first)).groupBy(*keys).agg(F.min("r").alias("header_row"))
        heads = cells.join(at.hint("merge"), keys).where("r = header_row")
    else:
        heads = cells.where(F.col("r") == row).withColumn("header_row", F.col("r"))
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return heads.withColumn("field", F.try_element_at(known, label)).where("field IS NOT NULL").groupBy(*keys, "header_row", "field").agg(F.min("c").alias("c"))


def read_table(cells: DataFrame, keys: list[str], header: DataFrame, fields: list[str], stop: str) -> DataFrame:
    """(keys, r, fields, is_total) of the rows under the header whose first field isn't blank, up to the first that begins with `stop`, the total."""
    rows = cells.join(header.hint("merge"), [*keys, "c"]).where("r > header_row").groupBy(*keys, "r").agg(*(F.max(F.when(F.col("field") == f, F.trim("v"))).alias(f) for f in fields))
    rows = rows.where(F.coalesce(F.col(fields[0]), F.lit("")) != "").withColumn("is_total", F.lower(fields[0]).startswith(stop))
    first = F.min(F.when(F.col("is_total"), F.col("r"))).over(Window.partitionBy(*keys))
    return rows.withColumn("_t", first).where("_t IS NULL OR r <= _t").drop("_t")


def stitched(cells: DataFrame, keys: list[str], names: dict[str, str], first: str) -> DataFrame:
    """(keys, r, c, v) of sheets that were printed over several pages: cells(keys, page, r, c, v) as one sheet, as if it had one page.

    A page whose first column of cells holds the label `first` repeats the header; its columns hold what that header says, even if they
    changed places. A page without one goes on under the header of the last page before it that has one, moved sideways by as much as its
    left edge is. Rows are numbered over all pages in order; the first header becomes row 0, columns are those of the fields in names, in
    order, and repeated headers, cells under no label and what stands before the first header are left out. Empty pages and sheets
    without a header give nothing.
    """
    label = parsing.header(F.col("v"))
    full = cells.where(F.trim("v") != "")
    edge = full.groupBy(*keys, "page").agg(F.min("c").alias("left"))
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    at = full.join(edge.hint("merge"), [*keys, "page"]).where((F.col("c") == F.col("left")) & (label == first)).groupBy(*keys, "page").agg(F.min("r").alias("header_row"))
    heads = full.join(at.hint("merge"), [*keys, "page"]).where("r = header_row").withColumn("field", F.try_element_at(known, label)).where("field IS NOT NULL")
    heads = heads.groupBy(*keys, "page", "header_row", "field").agg(F.min("c").alias("c"))
    heads = heads.groupBy(*keys, "page", "header_row").agg(F.map_from_entries(F.collect_list(F.struct("c", "field"))).alias("fields"))
    w = Window.partitionBy(*keys).orderBy("page").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pages = edge.join(heads.hint("merge"), [*keys, "page"], "left").withColumn("_left", F.when(F.col("fields").isNotNull(), F.col("left")))
    pages = pages.withColumns({"fields": F.last("fields", True).over(w), "shift": F.col("left") - F.last("_left", True).over(w)}).where("fields IS NOT NULL")
    rows = full.join(pages.hint("merge"), [*keys, "page"]).where("header_row IS NULL OR r > header_row")
    fields = list(dict.fromkeys(names.values()))
    column = F.create_map(*(F.lit(x) for i, f in enumerate(fields) for x in (f, i)))
    rows = rows.withColumn("c", F.try_element_at(column, F.try_element_at("fields", F.col("c") - F.col("shift")))).where("c IS NOT NULL")
    order = Window.partitionBy(*keys).orderBy("page", "r")
    rows = rows.select(*keys, F.dense_rank().over(order).alias("r"), "c", "v")
    label_of = {f: next(k for k, x in names.items() if x == f) for f in fields}
    header = pages.select(*keys).distinct().select("*", F.lit(0).alias("r"), F.posexplode(F.array(*(F.lit(label_of[f]) for f in fields))).alias("c", "v"))
    return header.unionByName(rows)


def dashboard_categories(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, name, qty, sales, is_total) of the table under `Service Categories`: rows up to the first without a name or to TOTALS. Its
    header says where qty and sales stand, by default in the second and fifth column; rows without sales are left out, but for TOTALS."""
    label = F.lower(F.trim("v"))
    head = cells.where((F.col("c") == 0) & (label == "service categories")).groupBy(*keys).agg(F.min("r").alias("h"))
    at = lambda name, column: F.coalesce(F.max(F.when(label == name, F.col("c"))), F.lit(column)).alias(f"_{name}")
    head = cells.join(head, keys).where("r = h").groupBy(*keys, "h").agg(at("qty", 1), at("sales", 4))
    value = lambda name: parsing.money(F.max(F.when(F.col("c") == F.col(f"_{name}"), F.col("v")))).alias(name)
    rows = cells.join(head, keys).where("r > h").groupBy(*keys, "h", "r").agg(F.max(F.when(F.col("c") == 0, F.trim("v"))).alias("name"), value("qty"), value("sales"))
    rows = rows.where("coalesce(name, '') <> ''").withColumn("is_total", F.lower("name") == "totals")
    w = Window.partitionBy(*keys).orderBy("r")
    before = F.coalesce(F.sum(F.col("is_total").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumns({"_n": F.row_number().over(w), "_t": before}).where("r - h = _n AND _t = 0")
    return rows.where("is_total OR sales IS NOT NULL").select(*keys, "name", "qty", "sales", "is_total")


def dashboard_rows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """A location's row of each dashboard sheet: the figures beside its labels, the first of equal ones, the buckets of its categories, and flags.

    All categories together, those of no bucket and negative ones too, must be the service to the cent: gap says by how much they are not.
    flags holds unreconciled, totals_row and revenue where the sums, the printed TOTALS row or the printed revenue do not agree.
    """
    label = F.lower(F.trim("v"))
    beside = cells.where("c = 1").select(*keys, "r", F.col("v").alias("value"))
    pairs = cells.where("c = 0").select(*keys, "r", label.alias("label")).where(F.col("label").isin(*DASHBOARD)).join(beside, [*keys, "r"])
    out = pairs.groupBy(*keys).agg(*(F.min_by("value", F.when(F.col("label") == k, F.col("r"))).alias(f) for k, f in DASHBOARD.items()))
    c = dashboard_categories(cells, keys)
    kept, name = ~F.col("is_total"), F.lower("name")
    sums = [F.sum(F.when(kept & name.isin(*names), F.col(v))).alias(f"{b}_{n}") for b, names in BUCKETS.items() for n, v in (("net", "sales"), ("count", "qty"))]
    c = c.groupBy(*keys).agg(*sums, F.sum(F.when(kept, F.col("sales"))).alias("categories_net"), F.max(F.when(~kept, F.col("sales"))).alias("printed"))
    day = lambda n: F.try_to_date(F.regexp_extract("period", r"(\d{1,2}/\d{1,2}/\d{4}).*?(\d{1,2}/\d{1,2}/\d{4})", n), "M/d/yyyy")
    money = {f: parsing.money(F.col(f)) for f in ("service", "product", "revenue", "tips")}
    out = out.withColumns({"period_start": day(1), "period_end": day(2), "guests": parsing.money(F.col("guests")).cast("long"), "hours": F.round(parsing.hours(F.col("hours")), 2), **money})
    out = out.join(c, keys, "left").withColumns({"total_sales": F.col("service") + F.col("product"), "gap": F.col("service") - F.col("categories_net")})
    off = lambda a, b, flag: F.when(F.abs(a - b) > CENT, F.lit(flag))
    flags = F.array_compact(F.array(off(F.col("gap"), F.lit(0), "unreconciled"), off(F.col("printed"), F.col("service"), "totals_row"), off(F.col("revenue"), F.col("total_sales"), "revenue")))
    return out.withColumns({"reconciled": F.coalesce(F.abs("gap") <= CENT, F.lit(False)), "flags": F.array_join(flags, ";")}).drop("period", "printed")


def provider_rows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the provider report with figures, and kind: total, artifact, active (service or hours) or zero."""
    rows = read_table(cells, keys, header_map(cells, keys, PROVIDER, first="provider name"), list(dict.fromkeys(PROVIDER.values())), "totals")
    rows = rows.withColumns({f: parsing.money(F.col(f)) for f in ("service", "product", "hours", "clients", "req")})
    worked = (F.coalesce("service", F.lit(0)) > 0) | (F.coalesce("hours", F.lit(0)) > 0)
    return rows.withColumn("kind", F.when(F.col("is_total"), "total").when(is_artifact(F.col("name")), "artifact").when(worked, "active").otherwise("zero"))


def totals_gap(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Service and product of all rows, artifacts included, against the total row; a sheet without one does not reconcile."""
    t, c = F.col("kind") == "total", ("service", "product")
    sums = [F.sum(F.when(~t, F.coalesce(x, F.lit(0)))).cast("double").alias(f"sum_{x}") for x in c] + [F.max(F.when(t, F.col(x))).cast("double").alias(f"total_{x}") for x in c]
    out = rows.groupBy(*keys).agg(*sums, F.count_if(F.col("kind") == "active").alias("n_active"), F.count_if(F.col("kind") == "artifact").alias("n_artifacts"), F.count_if(F.col("kind") == "zero").alias("n_zero"))
    gap = {f"gap_{x}": F.round(F.col(f"total_{x}") - F.coalesce(f"sum_{x}", F.lit(0.0)), 2) for x in c}
    return out.withColumns(gap).withColumn("reconciled", F.coalesce((F.abs("gap_service") <= CENT) & (F.abs("gap_product") <= CENT), F.lit(False)))


def phrases(text: Column, most: int = 3) -> Column:
    """All runs of up to `most` words of a text."""
    words = F.split(F.trim(text), r"\s+")
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size(words) - i + 1)), lambda n: F.array_join(F.slice(words, i, n), " ")))))


def detect_location(rows: DataFrame, keys: list[str], text: str, names: DataFrame) -> DataFrame:
    """(keys, location): of names(location) that a sheet's texts hold as whole words, one that is a whole text before others, then the longest."""
    hits = rows.select(*keys, text, F.explode(phrases(F.col(text))).alias("location")).join(names.select("location").distinct(), "location")
    rank = F.struct((F.trim(F.col(text)) != F.col("location")).cast("int"), -F.length("location"), "location")
    return hits.groupBy(*keys).agg(F.min_by("location", rank).alias("location"))


def block(cells: DataFrame, keys: list[str], rows: tuple[int, int], fields: dict[int, str]) -> DataFrame:
    """(keys, name, fields) of a fixed block of rows; column 0 is the name, and blank names and totals are left out."""
    part = cells.where(F.col("r").between(*rows)).groupBy(*keys, "r").agg(F.max(F.when(F.col("c") == 0, F.trim("v"))).alias("name"), *(parsing.money(F.max(F.when(F.col("c") == c, F.col("v")))).alias(f) for c, f in fields.items()))
    return part.where("coalesce(name, '') <> '' AND lower(name) NOT LIKE 'total%'").drop("r")


# Queries: sheets are made from the order tables and read again.


def _staff(spark, sf_dir) -> DataFrame:
    m = facts.totals(facts.lines(spark, sf_dir).withColumn("year_month", facts.year_month(F.col("week_ending"))), ["stylist_name", "loc_name", "loc_id", "manager", "platform", "year_month"])
    return m.withColumn("k", F.regexp_extract("stylist_name", r"(\d+)", 1).cast("int"))


def _cells(rows: DataFrame, keys: list[str], values: Column) -> DataFrame:
    """Cells of rows(keys, r) from an array of values; null values are absent."""
    return rows.select(*keys, F.col("r").cast("int").alias("r"), F.posexplode(values).alias("c", "v")).where("v IS NOT NULL")


def _text(c) -> Column:
    return F.format_number(F.col(c) if isinstance(c, str) else c, 2)


def _provider_cells(spark, sf_dir) -> DataFrame:
    """Columns change places in even months; every sheet has an artifact with money, an idle row, a total (off in every March) and a remark under it."""
    work = work_folder(spark, "cells")  # seven parts of the sheets read the staff, and their readers read the cells several times
    s = stored(_staff(spark, sf_dir).withColumn("r", F.row_number().over(Window.partitionBy(*SHEET).orderBy("stylist_name")) + 2), work)
    even = F.substring("year_month", 6, 2).cast("int") % 2 == 0
    put = lambda a, b, c, d, e, f: F.when(even, F.array(a, c, b, d, e, f)).otherwise(F.array(a, b, c, d, e, f))
    lit = lambda *x: put(*map(F.lit, x))
    sheets = s.groupBy(*SHEET).agg((F.count("*") + 3).alias("n"), F.sum("service").alias("service"), F.sum("product").alias("product"), F.sum("prod_hours").alias("hours"), F.sum("guests").alias("guests"))
    sheets = stored(sheets, work)
    off = F.when(F.col("year_month").endswith("-03"), 1).otherwise(0).cast(MONEY)
    row = lambda r, values: _cells(sheets.withColumn("r", r), SHEET, values)
    parts = [
        row(F.lit(0), F.array(F.lit("Store name:"), F.col("loc_name"))),
        row(F.lit(2), lit(" Provider  Name", "Service Sales", "Retail Sales", "Hours Worked", "Service Clients", "Req %")),
        _cells(s, SHEET, put(F.col("stylist_name"), _text("service"), _text("product"), _text("prod_hours"), F.col("guests").cast("string"), F.lit("25"))),
        row(F.col("n"), lit("House _", "-17.50", "26.25", "0", "0", None)), row(F.col("n") + 1, lit("Idle Person", "0.00", "0.00", "0", "0", None)),
        row(F.col("n") + 2, put(F.lit("Totals"), _text(F.col("service") - F.lit("17.50").cast(MONEY)), _text(F.col("product") + F.lit("26.25").cast(MONEY) + off), _text("hours"), F.col("guests").cast("string"), F.lit(None))),
        row(F.col("n") + 3, lit("Not a provider", "1", "1", "1", "1", "1")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return stored(out, work)


def provider_header(spark, sf_dir):
    c = _provider_cells(spark, sf_dir)
    out = header_map(c, SHEET, PROVIDER, first="provider name").groupBy(*SHEET, "header_row").pivot("field", ["name", "service", "product", "hours"]).agg(F.min("c"))
    return kpi.plain(out, out.columns)


def provider_kinds(spark, sf_dir):
    out = provider_rows(_provider_cells(spark, sf_dir), SHEET)
    return kpi.plain(out, [*SHEET, "name", "kind", "service", "product", "hours", "clients"])


def _paged(cells: DataFrame) -> DataFrame:
    """Sheets cut into pages of four rows, of which every third repeats the header; pages lie one, two or no columns to the right of the
    first, in the order of their numbers, and begin to count rows anew."""
    label = parsing.header(F.col("v"))
    at = cells.where((F.col("c") == 0) & (label == "provider name")).groupBy(*SHEET).agg(F.min("r").alias("h"))
    cells = cells.join(at.hint("merge"), SHEET)
    page = F.greatest(F.lit(0), F.floor((F.col("r") - F.col("h") - 1) / 4)).cast("int")
    body = cells.select(*SHEET, page.alias("page"), "r", "c", "v", "h")
    again = body.where("r > h AND page % 3 = 2").select(*SHEET, "page").distinct().join(cells.where("r = h").hint("merge"), SHEET).select(*SHEET, "page", F.col("h").alias("r"), "c", "v", "h")
    every = body.unionByName(again)
    row = F.when((F.col("page") > 0) & (F.col("r") == F.col("h")), F.lit(0)).when(F.col("page") > 0, F.col("r") - F.col("h") - F.col("page") * 4).otherwise(F.col("r"))
    every = every.select(*SHEET, "page", row.cast("int").alias("r"), (F.col("c") + F.col("page") % 3).alias("c"), "v")
    return stored(every, work_folder(cells.sparkSession, "pages"))


def paged_providers(spark, sf_dir):
    """Provider reports printed over several pages, with repeated and missing headers and shifted columns, give the rows of the whole sheet."""
    out = provider_rows(stitched(_paged(_provider_cells(spark, sf_dir)), SHEET, PROVIDER, "provider name"), SHEET)
    return kpi.plain(out, [*SHEET, "name", "kind", "service", "product", "hours", "clients"])


def provider_totals(spark, sf_dir):
    return totals_gap(provider_rows(_provider_cells(spark, sf_dir), SHEET), SHEET)


def provider_contract(spark, sf_dir):
    """Active rows of the provider report in the 18 columns: guests are service clients, requests a fraction."""
    p = provider_rows(_provider_cells(spark, sf_dir), SHEET).where("kind = 'active'")
    s, d, h, g = (F.col(c).cast("double") for c in ("service", "product", "hours", "clients"))
    div = lambda a, b: F.coalesce(kpi.rounded(F.try_divide(a, b), 2), F.lit(0.0))
    first = F.to_date(F.concat("year_month", F.lit("-01")))
    ids = facts.places(spark, sf_dir).select("loc_name", F.col("loc_id").cast("long").alias("loc_id")).distinct()
    made = {
        "platform": F.lit("salon_ultimate"), "invoices": g.cast("long"), "guests": g.cast("long"), "net_service": s, "net_product": d, "avg_ticket": div(s + d, g), "pph": div(s, h), "ppg": div(d, g), "production_hours": h,
        "source": F.lit("tracker"), "period_start": first, "period_end": F.last_day(first), "req_pct": F.coalesce(F.col("req").cast("double") / 100, F.lit(0.0)), "avg_service_time_min": F.lit(0.0),
    }
    return p.join(ids, "loc_name").withColumns(made).select(STAFF)


def grid_label(spark, sf_dir):
    """The value beside a label, wherever its row is."""
    cells = _provider_cells(spark, sf_dir)
    pairs = cells.where("c = 0").select(*SHEET, "r", F.col("v").alias("label")).join(cells.where("c = 1").select(*SHEET, "r", F.col("v").alias("value")), [*SHEET, "r"]).withColumnRenamed("r", "row")
    return parsing.grid_value(pairs, SHEET, "Store name:")


def dashboard_salon_rows(spark, sf_dir):
    """Dashboards of all location-months: one in three has its columns elsewhere, in May a category is missing, in June the revenue is off."""
    g = _staff(spark, sf_dir).groupBy(*SHEET).agg(*(F.sum(c).alias(c) for c in ("guests", "service", "product", "prod_hours", "wax_count", "wax", "color", "treat_count", "treat")))
    m = F.substring("year_month", 6, 2).cast("int")
    rest = F.col("service") - F.col("wax") - F.col("color") - F.col("treat") + 20 - 3
    first = F.to_date(F.concat("year_month", F.lit("-01")))
    s = lambda c: c.cast("string")
    pair = lambda a, b: F.array(F.lit(a), b)
    row = lambda name, qty, sales: F.when(m % 3 == 0, F.array(F.lit(name), F.lit("-"), s(sales), s(qty))).otherwise(F.array(F.lit(name), s(qty), F.lit("-"), F.lit("1%"), s(sales)))
    head = F.when(m % 3 == 0, F.array(*map(F.lit, ("Service Categories", "x", "Sales", "Qty")))).otherwise(F.array(*map(F.lit, ("Service Categories", "Qty", "Avg", "%", "Sales"))))
    lines = F.array(
        pair(" Store name: ", F.concat(F.lit("FS - "), F.col("loc_name"))), pair("Report period:", F.concat(F.date_format(first, "MM/dd/yyyy"), F.lit(" - "), F.date_format(F.last_day(first), "M/d/yyyy"))),
        pair("Total Service", F.concat(F.lit("$"), _text("service"))), pair("TOTAL RETAIL", _text("product")), pair("Total Revenue", _text(F.col("service") + F.col("product") + F.when(m == 6, 1).otherwise(0))),
        pair("TOTAL Guests", s(F.col("guests"))), pair("Total Service", F.lit("1")), pair("Tips", F.lit("$12.50")), pair("Production Hours", F.concat(s(F.floor("prod_hours")), F.lit("h 30m"))), head,
        row("Haircut", F.lit(5), rest), row("Color", F.col("wax_count"), F.col("color")), row("Colour", F.lit(1), F.lit(3)), row("Waxing", F.col("wax_count"), F.col("wax")), row("None", F.lit(1), F.lit(-20)),
        F.when(m != 5, row("Treatments", F.col("treat_count"), F.col("treat"))).otherwise(F.array(F.lit("Note"), F.lit("no figures"))), row("TOTALS", F.lit(9), F.col("service")), row("Wax", F.lit(99), F.lit(99)),
    )
    cells = g.select(*SHEET, F.posexplode(lines).alias("r", "line")).select(*SHEET, "r", F.posexplode("line").alias("c", "v"))
    out = dashboard_rows(cells, SHEET)
    return kpi.plain(out, out.columns)


def category_reconciliation(spark, sf_dir):
    """Service by category, a refund as a negative one, against a location-month's service: gap and gap as a share."""
    li = facts.lines(spark, sf_dir).withColumn("year_month", facts.year_month(F.col("week_ending"))).where("p_type <> 'PROMO'")
    net = F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("net")).cast(MONEY)
    sums = li.groupBy(*SHEET, F.col("p_type").alias("category")).agg(F.sum(net).alias("net")).groupBy(*SHEET).agg(F.sum("net").alias("categories"))
    whole = li.groupBy(*SHEET).agg(F.sum("net").alias("service"))
    out = whole.join(sums, SHEET).withColumn("gap", F.col("service") - F.col("categories"))
    out = kpi.plain(out, [*SHEET, "service", "categories", "gap"])
    return out.withColumn("gap_pct", F.when(F.col("service") != 0, F.col("gap") / F.abs("service"))).withColumn("ok", F.abs("gap") <= CENT)


def _workbook(spark, sf_dir) -> DataFrame:
    """One sheet a location and month: a title, the manager's row, headers in row 4, people, a manager among them, Total, and a remark."""
    s = _staff(spark, sf_dir).withColumn("r", F.row_number().over(Window.partitionBy(*SHEET, "loc_id").orderBy("stylist_name")) + 4)
    keys = [*SHEET, "loc_id"]
    sheets = s.groupBy(*keys).agg((F.count("*") + 5).alias("n"), F.sum("service").alias("service"), F.sum("product").alias("product"))
    row = lambda r, *values: _cells(sheets.withColumn("r", r), keys, F.array(*values))
    who = F.when(F.col("loc_id") % 2 == 0, F.col("loc_name")).otherwise(F.concat(F.col("loc_name"), F.lit(" shop mgr")))
    parts = [
        row(F.lit(1), F.lit("Employee KPI"), F.lit(None), F.lit(None)), row(F.lit(4), F.lit("Employee"), F.lit("Product"), F.lit("Service")),
        _cells(s, keys, F.array(F.when(F.col("k") % 4 == 0, F.concat("stylist_name", F.lit(" mgr"))).otherwise(F.col("stylist_name")), _text("product"), _text("service"))),
        row(F.col("n"), who, F.lit("0"), F.lit("0")), row(F.col("n") + 1, F.lit("Total"), _text("product"), _text("service")), row(F.col("n") + 2, F.lit("printed"), F.lit("7"), F.lit("7")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.concat_ws("|", F.lit("sheet"), "loc_id", "year_month").alias("sheet"), "r", "c", "v")


def _employees(spark, sf_dir) -> DataFrame:
    cells = _workbook(spark, sf_dir)
    rows = read_table(cells, ["sheet"], header_map(cells, ["sheet"], {"employee": "name", "product": "product", "service": "service"}, row=4), ["name", "product", "service"], "total")
    return rows.withColumns({c: parsing.money(F.col(c)) for c in ("product", "service")})


def employee_rows(spark, sf_dir):
    """Persons of each sheet who sold something: no managers, no total."""
    e = _employees(spark, sf_dir).where("NOT is_total AND (service > 0 OR product > 0)").where(~F.lower("name").endswith("mgr"))
    return kpi.plain(e, ["sheet", "name", "service", "product"])


def employee_totals(spark, sf_dir):
    """The total of each sheet with the location that its manager rows name."""
    e = _employees(spark, sf_dir)
    names = facts.places(spark, sf_dir).select(F.col("loc_name").alias("location")).distinct()
    found = detect_location(e.where("NOT is_total"), ["sheet"], "name", names)
    return kpi.plain(e.where("is_total").join(found, "sheet"), ["sheet", "location", "service", "product"])


def tracker_blocks(spark, sf_dir):
    """Money of a manager's locations in one block of a sheet, counts in another, joined by name; both have totals."""
    m = facts.location_months(spark, sf_dir)
    keys = ["manager", "year_month"]
    i = F.row_number().over(Window.partitionBy(*keys).orderBy("loc_name"))
    rows = m.withColumn("i", i)
    n = rows.groupBy(*keys).agg(F.max("i").alias("n"), F.sum("service").alias("service"))
    cells = _cells(rows.withColumn("r", F.col("i") + 2), keys, F.array("loc_name", _text("service"), _text("product")))
    cells = cells.unionByName(_cells(rows.withColumn("r", F.col("i") + 18), keys, F.array(F.upper(F.concat(F.lit(" "), F.col("loc_name"))), F.col("guests").cast("string"), _text("prod_hours"))))
    cells = cells.unionByName(_cells(n.withColumn("r", F.col("n") + 3), keys, F.array(F.lit("Totals"), _text("service"), F.lit("0"))))
    top, low = block(cells, keys, (3, 14), {1: "service", 2: "product"}), block(cells, keys, (19, 30), {1: "guests", 2: "prod_hours"})
    same = F.lower(F.trim("name"))
    out = top.withColumn("key", same).join(low.select(*keys, same.alias("key"), "guests", "prod_hours"), [*keys, "key"])
    return kpi.plain(out, [*keys, "name", "service", "product", "guests", "prod_hours"])


def tracker_weeks(spark, sf_dir):
    """Weeks of a location-month side by side in one row; a layout says in which columns each week stands."""
    from tallyloom.operators.cumulative import week_in_month

    w = week_in_month(facts.location_weeks(spark, sf_dir))
    wide = w.select(*SHEET, F.lit(1).alias("r"), F.inline(F.array(F.struct(((F.col("week_idx") - 1) * 4 + 1).alias("c"), F.col("guests").cast("string").alias("v")), F.struct(((F.col("week_idx") - 1) * 4 + 2).alias("c"), _text("service").alias("v")))))
    layout = spark.createDataFrame([(i, 4 * (i - 1) + 1 + j, f) for i in range(1, 7) for j, f in enumerate(("guests", "service"))], "week_idx int, c int, field string")
    cells = wide.join(layout, "c")
    out = cells.groupBy(*SHEET, "week_idx").agg(*(parsing.money(F.max(F.when(F.col("field") == f, F.col("v")))).alias(f) for f in ("guests", "service")))
    return kpi.plain(out, [*SHEET, "week_idx", "guests", "service"])


def tracker_years(spark, sf_dir):
    """A sheet with a column for every year of the table, unpivoted again."""
    m = kpi.with_ratios(facts.location_months(spark, sf_dir)).select("loc_name", F.substring("year_month", 6, 2).alias("month"), F.substring("year_month", 1, 4).alias("year"), "total_sales")
    wide = m.groupBy("loc_name", "month").agg(F.map_from_entries(F.collect_list(F.struct("year", F.col("total_sales").cast("double")))).alias("years"))
    return wide.select("loc_name", "month", F.explode("years").alias("year", "total_sales"))


QUERIES = {
    f.__name__: f
    for f in (provider_header, provider_kinds, paged_providers, provider_totals, provider_contract, grid_label, dashboard_salon_rows, category_reconciliation, employee_rows, employee_totals, tracker_blocks, tracker_weeks, tracker_years)
}

_ST = f"""{facts.LINES_SQL},
st AS (SELECT *, regexp_extract(stylist_name, '(\\d+)', 1)::INT AS k FROM ({facts.totals_sql("stylist_name, loc_name, loc_id, manager, platform, year_month", rows="(SELECT *, strftime(week_ending, '%Y-%m') AS year_month FROM lines)")})),
sheets AS (SELECT loc_name, loc_id, year_month, sum(service) AS service, sum(product) AS product, sum(prod_hours) AS hours, sum(guests) AS guests, count(*) AS n FROM st GROUP BY ALL)"""
_R2 = lambda a, b: f"coalesce({kpi.rounded_sql(f'({a})::DOUBLE / nullif(({b})::DOUBLE, 0)', 2)}, 0.0)"
ORACLE = {
    "provider_header": f"""WITH {_ST}, e AS (SELECT *, substr(year_month, 6, 2)::INT % 2 = 0 AS even FROM sheets)
SELECT loc_name, year_month, 2 AS header_row, 0 AS name, CASE WHEN even THEN 2 ELSE 1 END AS service, CASE WHEN even THEN 1 ELSE 2 END AS product, 3 AS hours FROM e""",
    "provider_kinds": f"""WITH {_ST} SELECT loc_name, year_month, stylist_name AS name, CASE WHEN service > 0 OR prod_hours > 0 THEN 'active' ELSE 'zero' END AS kind, service::DOUBLE AS service, product::DOUBLE AS product, prod_hours::DOUBLE AS hours, guests::DOUBLE AS clients FROM st
UNION ALL SELECT loc_name, year_month, 'House _', 'artifact', -17.5, 26.25, 0, 0 FROM sheets UNION ALL SELECT loc_name, year_month, 'Idle Person', 'zero', 0, 0, 0, 0 FROM sheets
UNION ALL SELECT loc_name, year_month, 'Totals', 'total', (service - 17.5)::DOUBLE, (product + 26.25 + CASE WHEN year_month LIKE '%-03' THEN 1 ELSE 0 END)::DOUBLE, hours::DOUBLE, guests::DOUBLE FROM sheets""",
    "provider_totals": f"""WITH {_ST} SELECT loc_name, year_month, (service - 17.5)::DOUBLE AS sum_service, (product + 26.25)::DOUBLE AS sum_product, (service - 17.5)::DOUBLE AS total_service,
  (product + 26.25 + CASE WHEN year_month LIKE '%-03' THEN 1 ELSE 0 END)::DOUBLE AS total_product, n AS n_active, 1 AS n_artifacts, 1 AS n_zero, 0.0::DOUBLE AS gap_service, CASE WHEN year_month LIKE '%-03' THEN 1.0 ELSE 0.0 END::DOUBLE AS gap_product,
  year_month NOT LIKE '%-03' AS reconciled FROM sheets""",
    "provider_contract": f"""WITH {_ST}, z AS (SELECT *, service::DOUBLE AS s, product::DOUBLE AS p, prod_hours::DOUBLE AS h, strptime(year_month || '-01', '%Y-%m-%d')::DATE AS first FROM st WHERE service > 0 OR prod_hours > 0)
SELECT year_month, stylist_name AS name, loc_name, loc_id, 'salon_ultimate' AS platform, guests AS invoices, guests, s AS net_service, p AS net_product, {_R2("s + p", "guests")} AS avg_ticket, {_R2("s", "h")} AS pph, {_R2("p", "guests")} AS ppg, h AS production_hours,
  'tracker' AS source, first AS period_start, last_day(first) AS period_end, 0.25::DOUBLE AS req_pct, 0.0::DOUBLE AS avg_service_time_min FROM z""",
    "grid_label": f"WITH {_ST} SELECT loc_name, year_month, loc_name AS value FROM sheets",
    "dashboard_salon_rows": f"""WITH {_ST}, g AS (SELECT loc_name, year_month, sum(guests) AS guests, sum(service)::DECIMAL(18,2) AS service, sum(product)::DECIMAL(18,2) AS product, sum(prod_hours) AS hours, sum(wax_count) AS wq, sum(wax) AS wax, sum(color) AS color,
  sum(treat_count) AS tq, sum(treat) AS treat, substr(year_month, 6, 2)::INT AS m, (year_month || '-01')::DATE AS first FROM st GROUP BY ALL),
x AS (SELECT *, CASE WHEN m = 5 THEN treat ELSE 0 END AS gap FROM g)
SELECT loc_name, year_month, 'FS - ' || loc_name AS store_name, first AS period_start, last_day(first) AS period_end, service::DOUBLE AS service, product::DOUBLE AS product, (service + product + CASE WHEN m = 6 THEN 1 ELSE 0 END)::DOUBLE AS revenue, guests::BIGINT AS guests,
  12.5::DOUBLE AS tips, floor(hours)::DOUBLE + 0.5 AS hours, (color + 3)::DOUBLE AS color_net, (wq + 1)::DOUBLE AS color_count, wax::DOUBLE AS wax_net, wq::DOUBLE AS wax_count, CASE WHEN m <> 5 THEN treat::DOUBLE END AS treatment_net, CASE WHEN m <> 5 THEN tq::DOUBLE END AS treatment_count,
  (service - gap)::DOUBLE AS categories_net, (service + product)::DOUBLE AS total_sales, gap::DOUBLE AS gap, abs(gap) <= 0.01 AS reconciled,
  concat_ws(';', CASE WHEN abs(gap) > 0.01 THEN 'unreconciled' END, CASE WHEN m = 6 THEN 'revenue' END) AS flags FROM x""",
    "category_reconciliation": f"""WITH {facts.LINES_SQL}, x AS (SELECT loc_name, strftime(week_ending, '%Y-%m') AS year_month, sum(net) AS service, sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE net END) AS categories FROM lines WHERE p_type <> 'PROMO' GROUP BY ALL),
y AS (SELECT loc_name, year_month, service::DOUBLE AS service, categories::DOUBLE AS categories, (service - categories)::DOUBLE AS gap FROM x)
SELECT *, CASE WHEN service <> 0 THEN gap / abs(service) END AS gap_pct, abs(gap) <= 0.01::DOUBLE AS ok FROM y""",
    "employee_rows": f"""WITH {_ST} SELECT 'sheet|' || loc_id || '|' || year_month AS sheet, stylist_name AS name, service::DOUBLE AS service, product::DOUBLE AS product FROM st WHERE k % 4 <> 0 AND (service > 0 OR product > 0)""",
    "employee_totals": f"WITH {_ST} SELECT 'sheet|' || loc_id || '|' || year_month AS sheet, loc_name AS location, service::DOUBLE AS service, product::DOUBLE AS product FROM sheets",
    "tracker_blocks": f"WITH {facts.MONTHS_SQL} SELECT manager, year_month, loc_name AS name, service::DOUBLE AS service, product::DOUBLE AS product, guests::DOUBLE AS guests, prod_hours::DOUBLE AS prod_hours FROM lm",
    "tracker_weeks": f"WITH {facts.WEEKS_SQL} SELECT loc_name, year_month, dense_rank() OVER (PARTITION BY year_month ORDER BY week_ending) AS week_idx, guests::DOUBLE AS guests, service::DOUBLE AS service FROM lw",
    "tracker_years": f"WITH {facts.MONTHS_SQL} SELECT loc_name, substr(year_month, 6, 2) AS month, substr(year_month, 1, 4) AS year, (service + product)::DOUBLE AS total_sales FROM lm",
}
ORACLE["paged_providers"] = ORACLE["provider_kinds"]
