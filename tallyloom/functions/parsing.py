"""Parsers of report text: money, hours, percents, dates, headers, names, dialects. All are total: bad text gives null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(text: Column) -> Column:
    """$1,234.56, ($80.00), -$80 and $-80."""
    t = F.trim(text)
    negative = t.rlike(r"^\(.*\)$") | t.contains("-")
    value = F.regexp_replace(t, r"[$,()\s-]", "").try_cast(MONEY)
    return F.when(negative, -value).otherwise(value)


def number(text: Column, default: float | None = 0.0) -> Column:
    """A double with signs of thousands, currency and percent left out; default for bad or null text."""
    value = F.regexp_replace(F.trim(text), r"[,$%]", "").try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


def hours(text: Column) -> Column:
    """287h 18m as hours; either part may be missing."""
    part = lambda unit: F.regexp_extract(text, rf"(\d+(?:\.\d+)?)\s*{unit}", 1).try_cast("double")
    h, m = part("h"), part("m")
    return F.when(h.isNotNull() | m.isNotNull(), F.coalesce(h, F.lit(0.0)) + F.coalesce(m, F.lit(0.0)) / 60).otherwise(F.trim(text).try_cast("double"))


def fraction(value: Column) -> Column:
    """Values of at most one are fractions already, others percents."""
    return F.when(F.abs(value) <= 1, value).otherwise(value / 100)


def day(text: Column) -> Column:
    """ISO, M/D/YYYY, D Mon YYYY, or the serial number of a spreadsheet, whose day 0 is 1899-12-30."""
    t = F.trim(text)
    serial = F.when(t.rlike(r"^\d{1,5}(\.\d+)?$"), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(t.try_cast("double")).cast("int")))
    return F.coalesce(F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"), F.try_to_date(t, "M/d/yyyy"), F.try_to_date(t, "d MMM yyyy"), serial)


def header(text: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(text), r"\s+", " "))


# What a name may end in.
SUFFIXES = r"\b(jr|sr|ii|iii|pt|ft|mgr|manager|lead|asst|assistant)\b\.?"


def person(text: Column) -> Column:
    """A name without remarks in brackets, suffixes and signs, in lower case."""
    t = F.regexp_replace(F.lower(text), r"\([^)]*\)", " ")
    t = F.regexp_replace(t, SUFFIXES, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[^a-z ]", ""), r" +", " "))


def stable_id(place: Column, name: Column, first_seen: Column, digits: int = 8) -> Column:
    """place, a slug of the name, and the start of a hash that tells two people of one name apart by when they came."""
    slug = F.substring(F.replace(name, F.lit(" "), F.lit("_")), 1, 20)
    return F.concat_ws("_", place, slug, F.substring(F.sha2(F.concat_ws("|", place, name, first_seen), 256), 1, digits))


#: Signs of each report dialect near a document's start.
DIALECTS = (("zenoti", ("employee sale details", "center name")), ("salon_ultimate", ("provider tracker", "total retail")))


def dialect(text: Column, signs=DIALECTS, within: int = 4000) -> Column:
    """The dialect whose signs the first characters show; null for none, or more than one."""
    head = F.lower(F.substring(text, 1, within))
    found = F.array_compact(F.array(*(F.when(F.greatest(*(head.contains(s) for s in words), F.lit(False)), F.lit(name)) for name, words in signs)))
    return F.when(F.size(found) == 1, found[0])


def date_range(text: Column) -> Column:
    """struct(first, last) of `From: M/D/YYYY To: M/D/YYYY` or `M/D/YYYY - M/D/YYYY`; null if the end is before the start."""
    d = r"(\d{1,2}/\d{1,2}/\d{4})"
    pick = lambda i: F.coalesce(*(F.try_to_date(F.nullif(F.regexp_extract(text, p, i), F.lit("")), "M/d/yyyy") for p in (rf"(?i)from:\s*{d}\s*to:\s*{d}", rf"{d}\s*-\s*{d}")))
    return F.when(pick(1) <= pick(2), F.struct(pick(1).alias("first"), pick(2).alias("last")))


def days_after(text: Column, marker: str, window: int = 400) -> Column:
    """Distinct dates, in order of their place, in the window after the marker; an empty array without it."""
    at = F.locate(marker, text)
    part = F.when(at > 0, F.substring(text, at, F.lit(window))).otherwise("")
    return F.array_distinct(F.transform(F.regexp_extract_all(part, F.lit(r"(\d{1,2}/\d{1,2}/\d{4})"), 1), lambda x: F.try_to_date(x, "M/d/yyyy")))


def plain_text(html: Column) -> Column:
    """HTML without scripts, styles and tags; white space becomes one blank."""
    t = F.regexp_replace(html, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"<[^>]*>", " "), r"\s+", " "))


def figures(text: Column, label: str) -> Column:
    """The amount after a label."""
    return money(F.nullif(F.regexp_extract(text, rf"(?i){label}\s*:?\s*(\(?-?\$?-?[\d,]+(?:\.\d+)?\)?)", 1), F.lit("")))


def person_numbers(text: Column, label: str) -> Column:
    """The numbers that follow the last line that begins with a label."""
    n = r"\(?-?\$?[\d,]+(?:\.\d+)?\)?"
    return F.transform(F.split(F.trim(F.regexp_extract(text, rf"(?s).*(?:^|\n)\s*{label}\s+({n}(?:\s+{n})*)", 1)), r"\s+"), money)


def person_rows(docs: DataFrame, text: str, least: int = 4, words: int = 3) -> DataFrame:
    """A row for each line that is a name of at most `words` words and at least `least` numbers: docs' columns, place, name, numbers."""
    n = r"\(?-?\$?[\d,]+(?:\.\d+)?\)?%?"
    rows = docs.select("*", F.posexplode(F.split(text, r"\r?\n")).alias("place", "_line"))
    shape = rf"^\s*([A-Za-z][A-Za-z.'-]*(?:\s+[A-Za-z][A-Za-z.'-]*){{0,{words - 1}}})\s+({n}(?:\s+{n}){{{least - 1},}})\s*$"
    rows = rows.where(F.col("_line").rlike(shape)).withColumns({"name": F.regexp_extract("_line", shape, 1), "_tail": F.regexp_extract("_line", shape, 2)})
    return rows.withColumn("numbers", F.transform(F.split("_tail", r"\s+"), money)).drop("_line", "_tail", text)


def grid_value(cells: DataFrame, keys: list[str], label: str) -> DataFrame:
    """The first value beside an exact label in cells(keys, row, label, value)."""
    return cells.where(F.trim("label") == label).groupBy(*keys).agg(F.min_by("value", "row").alias("value"))
