"""Labelled figures of report texts, by a table of labels: another dialect, or another label of one, is another row and no code.

A text is read once. At each word the longest label of the dialect and of the section that the text is in counts, by a tree of words; the
numbers that follow it are its figures. Lines with a figure under no label are reported, so a label that a vendor renamed is seen.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.summaries import _staff
from tallyloom.sources import facts

LABELS = "dialect string, section string, label string, field string, pick int, kind string"
#: Labels of all dialects that are collected, and characters after whole hours within which their minutes are looked for.
MOST, AHEAD = 20_000, 400
# Labels as the two systems print them, each with its fields, the number after it that they hold, and what that is. Labels
# without a field are there so that shorter ones are not read inside them; a kind of section begins one.
DIALECTS = [
    ("zenoti", None, "Service sales", "service_count", 1, "count"), ("zenoti", None, "Service sales", "service_gross", 2, "money"), ("zenoti", None, "Service sales", "service_net", 3, "money"),
    ("zenoti", None, "Product sales", "product_count", 1, "count"), ("zenoti", None, "Product sales", "product_gross", 2, "money"), ("zenoti", None, "Product sales", "product_net", 3, "money"),
    ("zenoti", None, "Service &", "subtotal_net", 3, "money"), ("zenoti", None, "Item total", "item_total_count", 1, "count"), ("zenoti", None, "Item total", "item_total_gross", 2, "money"),
    ("zenoti", None, "Item total", "item_total_net", 3, "money"), ("zenoti", None, "Sales(Inc. Tax)", "sales_inc_tax", 1, "money"), ("zenoti", None, "Tax", "tax", 1, "money"),
    ("zenoti", None, "Avg. invoice value", "avg_invoice_value_pdf", 1, "money"), ("zenoti", None, "Total guest count", "total_guest_count_pdf", 1, "count"),
    ("zenoti", None, "Net product sales per guest", "net_product_per_guest_pdf", 1, "money"), ("zenoti", None, "Net product sales/invoice", "net_product_per_invoice_pdf", 1, "money"),
    ("zenoti", None, "Net service sales/invoice", "net_service_per_invoice_pdf", 1, "money"), ("zenoti", None, "Net Sales/hr", "net_sales_per_hr_pdf", 1, "money"),
    ("zenoti", None, "Net Item sales/center hour", "net_item_sales_center_hour", 1, "money"), ("zenoti", None, "Net service sales/center hour", "net_service_sales_center_hour", 1, "money"),
    ("zenoti", None, "Net product sales/center hour", "net_product_sales_center_hour", 1, "money"), ("zenoti", None, "Days with no invoices", "days_with_no_invoices", 1, "count"),
    ("zenoti", None, "Refund invoices", "refund_invoices", 1, "count"), ("zenoti", None, "No show", "no_show_count", 1, "count"), ("zenoti", None, "Voids", "voids_count", 1, "count"),
    ("zenoti", None, "Rebooked", "rebooked_count", 1, "count"), ("zenoti", None, "Rebooked", "rebooked_pct", 2, "percent"),
    ("zenoti", None, "Total invoices with services or product", "invoice_count", 1, "count"), ("zenoti", None, "Total invoices with service or product", "invoice_count", 1, "count"),
    ("zenoti", None, "TIPS COLLECTED", None, None, "section"), ("zenoti", "TIPS COLLECTED", "Total", "tips_total", 1, "money"), ("zenoti", None, "EMPLOYEE SALE", None, None, "section"),
    ("zenoti", None, "EMPLOYEE PERFORMANCE", None, None, "section"), ("zenoti", None, "HOURLY WORK", None, None, "section"),
    ("salon_ultimate", None, "Total Service", "total_service", 1, "money"), ("salon_ultimate", None, "Total Retail", "total_retail", 1, "money"), ("salon_ultimate", None, "Total Revenue", "total_revenue", 1, "money"),
    ("salon_ultimate", None, "Tips", "tips", 1, "money"), ("salon_ultimate", None, "Avg Tips", None, 1, "money"), ("salon_ultimate", None, "Sales Tax", "sales_tax", 1, "money"),
    ("salon_ultimate", None, "Serviced Guests", "serviced_guests", 1, "count"), ("salon_ultimate", None, "Retail Only Guests", "retail_only_guests", 1, "count"),
    ("salon_ultimate", None, "TOTAL Guests", "total_guests_pdf", 1, "count"), ("salon_ultimate", None, "Rebook %", "rebook_pct", 1, "percent"), ("salon_ultimate", None, "Prebook %", "prebook_pct", 1, "percent"),
    ("salon_ultimate", None, "PPH", "pph_pdf", 1, "money"), ("salon_ultimate", None, "PPG", "ppg_pdf", 1, "money"), ("salon_ultimate", None, "TOTAL Avg Ticket", "avg_ticket_pdf", 1, "money"),
    ("salon_ultimate", None, "Walkin", "walk_ins", 1, "count"), ("salon_ultimate", None, "Online Appointments", "online_appointments_booked", 1, "count"),
    ("salon_ultimate", None, "New Request", "new_request", 1, "count"), ("salon_ultimate", None, "Male New Request", None, 1, "count"),
    ("salon_ultimate", None, "Returning Request", "returning_request", 1, "count"), ("salon_ultimate", None, "Male Returning Request", None, 1, "count"),
    ("salon_ultimate", None, "Production Hours", "production_hours", 1, "hours"), ("salon_ultimate", None, "Non-Production Hours", "non_production_hours", 1, "hours"),
    ("salon_ultimate", None, "NonProduction Hours", "non_production_hours", 1, "hours"), ("salon_ultimate", None, "Total Hours", "total_hours", 1, "hours"),
]
_NUMBER = re.compile(r"\(?-?\$?-?[\d,]*\.?\d+%?\)?")
_HOURS, _MINUTES = re.compile(r"(\d+)h"), re.compile(r"(\d{1,2})m")


def dialects(spark) -> DataFrame:
    return spark.createDataFrame(DIALECTS, LABELS)


def _words(text: str) -> list[str]:
    return text.lower().replace(":", " ").split()


class Labels:
    """A tree of words for each dialect and section."""

    def __init__(self, rows: list[tuple]):
        self.trees: dict[tuple, dict] = {}
        for dialect, section, label, field, pick, kind in rows:
            at = self.trees.setdefault((dialect, section and " ".join(_words(section))), {})
            for w in _words(label):
                at = at.setdefault(w, {})
            at.setdefault("", []).append((field, pick, kind))

    def longest(self, dialect: str, section: str | None, words: list[str], i: int) -> tuple[int, list]:
        best = (0, [])
        for tree in {None: self.trees.get((dialect, None), {}), section: self.trees.get((dialect, section), {})}.values():
            at, n = tree, 0
            while i + n < len(words) and (at := at.get(words[i + n])) is not None:
                n += 1
                if "" in at and n > best[0]:
                    best = (n, at[""])
        return best

    def read(self, dialect: str, text: str) -> list[tuple]:
        """(field, label, value): the first figure of each field, and without a field what stands before figures under no label."""
        tokens = [(m[0], m.start(), line) for line, part in enumerate(text.split("\n")) for m in re.finditer(r"[^\s:]+", part)]
        words, ends = [t[0].lower() for t in tokens], 0
        where, at = [], 0
        for part in text.split("\n"):
            where.append(at)
            at += len(part) + 1
        found, unknown, section, i, begun = {}, [], None, 0, 0
        while i < len(words):
            n, what = self.longest(dialect, section, words, i)
            if not n:
                if _NUMBER.fullmatch(words[i]) and i > begun >= ends and tokens[begun][2] == tokens[i][2] and any(c.isalpha() for c in words[begun]):
                    unknown.append((None, " ".join(t[0] for t in tokens[begun:i]), _number(words[i])))
                    ends = i + 1
                i += 1
                if i < len(words) and tokens[i][2] != tokens[i - 1][2]:
                    begun = i
                continue
            if any(kind == "section" for _, _, kind in what):
                section = " ".join(words[i : i + n])
            figures, after = [], i + n
            while after < len(words) and _NUMBER.fullmatch(words[after]):
                figures.append(_number(words[after]))
                after += 1
            for field, pick, kind in what:
                value = _hours(tokens, where, i + n) if kind == "hours" else figures[pick - 1] if pick and pick <= len(figures) else None
                if field and value is not None:
                    found.setdefault(field, (field, " ".join(t[0] for t in tokens[i : i + n]), value))
            i = ends = begun = after
        return [*found.values(), *unknown]


def _number(word: str) -> float:
    minus = word.startswith("-") or "$-" in word
    return float(re.sub(r"[^\d.]", "", word)) * (-1 if minus else 1)


def _hours(tokens: list[tuple], where: list[int], i: int) -> float | None:
    """Hours at a word: as a decimal, as 3h 15m, or whole ones whose minutes stand further on, after other columns of the page."""
    if i >= len(tokens):
        return None
    word, start, line = tokens[i]
    if re.fullmatch(r"\d+\.\d+h?", word):
        return float(word.rstrip("h"))
    if both := re.fullmatch(r"(\d+)h(\d+)m", word):
        return int(both[1]) + int(both[2]) / 60
    if not (h := _HOURS.fullmatch(word)):
        return None
    for w, s, other in tokens[i + 1 :]:
        if where[other] + s - where[line] - start > AHEAD:
            break
        if m := _MINUTES.fullmatch(w):
            return int(h[1]) + (int(m[1]) / 60 if int(m[1]) < 60 else 0)
    return float(h[1])


def labelled(docs: DataFrame, keys: list[str], dialect: str, text: str, labels: DataFrame) -> DataFrame:
    """(keys, field, label, value) of docs(keys, dialect, text) by labels(LABELS): each field's first figure, and rows without a field for
    what is under no label. A text that is null, or of a dialect without labels, gives only the latter, or nothing. labels is collected."""
    rows = [tuple(r) for r in labels.select(*(f.split()[0] for f in LABELS.split(", "))).limit(MOST + 1).collect()]
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} labels")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema.fields), "_found array<struct<field:string,label:string,value:double>>"])
    kind = pa.list_(pa.struct([("field", pa.string()), ("label", pa.string()), ("value", pa.float64())]))

    def run(batches):
        table = Labels(rows)
        for b in batches:
            found = [[dict(zip(("field", "label", "value"), x)) for x in table.read(d, t)] if t is not None else [] for d, t in zip(*(c.to_pylist() for c in b.columns[-2:]))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(found, kind)], [*keys, "_found"])

    return docs.select(*keys, F.col(dialect).alias("_d"), F.col(text).alias("_t")).mapInArrow(run, schema).select(*keys, F.inline("_found"))


# --- queries: a report a location and month, in the words of its system


def _money(c: Column) -> Column:
    return F.format_number(c.cast("decimal(18,2)"), 2)


def _reports(spark, sf_dir) -> DataFrame:
    g = _staff(spark, sf_dir).groupBy("loc_name", "year_month", "platform").agg(*(F.sum(c).alias(c) for c in ("guests", "service", "product", "hours")))
    n, s, p = F.col("guests").cast("string"), F.col("service"), F.col("product")
    z = F.concat_ws(
        "\n", F.concat_ws(" ", F.lit("Service sales"), n, _money(s + 1), _money(s), F.lit("(61.5)")), F.concat_ws(" ", F.lit("Product sales"), n, _money(p + 1), _money(p), F.lit("(38.5)")),
        F.concat_ws(" ", F.lit("Item total"), n, _money(s + p + 2), _money(s + p), F.lit("(100)")), F.concat(F.lit("Sales(Inc. Tax) "), _money(s + p + 5)), F.lit("Tax 5.00\nGift wrap 3"),
        F.concat(F.lit("Total invoices with services or product "), n), F.lit("TIPS COLLECTED AMOUNT\nCash 1.00"), F.concat(F.lit("Total "), _money(p + 7)), F.lit("EMPLOYEE SALE DETAILS\nTotal 9.00"),
    )
    u = F.concat_ws(
        "\n", F.concat(F.lit("Total Service: $"), _money(s)), F.concat(F.lit("Total  Retail $"), _money(p)), F.concat(F.lit("TOTAL REVENUE $"), _money(s + p)), F.concat(F.lit("Avg Tips $1.00 Tips $"), _money(p + 7)),
        F.concat(F.lit("Serviced Guests "), n), F.lit("Hat sales 4\nRebook % 12.5 %\nMale New Request 3\nNew Request 4"), F.concat(F.lit("Non-Production Hours 3h 30m\nProduction Hours "), F.floor("hours").cast("string"), F.lit("h\nCards 2\n"), (F.col("guests") % 60).cast("string"), F.lit("m")),
    )
    return g.select("loc_name", "year_month", "platform", F.when(F.col("platform") == "zenoti", z).otherwise(u).alias("text"))


def dialect_fields(spark, sf_dir):
    """The fields of both systems' reports by their own labels; labels of neither are reported."""
    return labelled(_reports(spark, sf_dir), ["loc_name", "year_month"], "platform", "text", dialects(spark)).select("loc_name", "year_month", "field", F.lower("label").alias("label"), "value")


def unknown_labels(spark, sf_dir):
    """Labels under which no field is, by system and how many reports have them; one of them gets a row of its own and is unknown no more."""
    more = dialects(spark).unionByName(spark.createDataFrame([("salon_ultimate", None, "Hat sales", "hat_sales", 1, "count")], LABELS))
    out = labelled(_reports(spark, sf_dir), ["loc_name", "year_month", "platform"], "platform", "text", more).where("field IS NULL")
    return out.groupBy("platform", F.lower("label").alias("label")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


QUERIES = {f.__name__: f for f in (dialect_fields, unknown_labels)}


def _sql() -> str:
    from tallyloom.operators.summaries import _STAFF

    row = lambda field, label, value: f"{{'field': {field}, 'label': '{label}', 'value': ({value})::DOUBLE}}"
    f = lambda name, label, value: row(f"'{name}'", label, value)
    tips = "p + 7"
    z = [f("service_count", "service sales", "n"), f("service_gross", "service sales", "s + 1"), f("service_net", "service sales", "s"), f("product_count", "product sales", "n"), f("product_gross", "product sales", "p + 1"), f("product_net", "product sales", "p"),
         f("item_total_count", "item total", "n"), f("item_total_gross", "item total", "s + p + 2"), f("item_total_net", "item total", "s + p"), f("sales_inc_tax", "sales(inc. tax)", "s + p + 5"), f("tax", "tax", "5"), row("NULL", "gift wrap", "3"),
         f("invoice_count", "total invoices with services or product", "n"), row("NULL", "cash", "1"), f("tips_total", "total", tips), row("NULL", "details total", "9")]
    u = [f("total_service", "total service", "s"), f("total_retail", "total retail", "p"), f("total_revenue", "total revenue", "s + p"), f("tips", "tips", tips), f("serviced_guests", "serviced guests", "n"), row("NULL", "hat sales", "4"), f("rebook_pct", "rebook %", "12.5"),
         f("new_request", "new request", "4"), f("non_production_hours", "non-production hours", "3.5"), f("production_hours", "production hours", "floor(h) + (n % 60)::DOUBLE / 60"), row("NULL", "cards", "2")]
    z.remove(row("NULL", "details total", "9"))
    z.append(row("NULL", "total", "9"))
    return f"""{_STAFF}, g AS (SELECT loc_name, year_month, platform, sum(guests) AS n, sum(service) AS s, sum(product) AS p, sum(hours) AS h FROM st GROUP BY 1, 2, 3),
r AS (SELECT loc_name, year_month, platform, unnest(CASE WHEN platform = 'zenoti' THEN [{', '.join(z)}] ELSE [{', '.join(u)}] END) AS x FROM g)"""


ORACLE = {
    "dialect_fields": f"WITH {_sql()} SELECT loc_name, year_month, x.field AS field, x.label AS label, x.value AS value FROM r",
    "unknown_labels": f"WITH {_sql()} SELECT platform, x.label AS label, count(*) AS n, sum(x.value) AS total FROM r WHERE x.field IS NULL AND x.label <> 'hat sales' GROUP BY 1, 2",
}
