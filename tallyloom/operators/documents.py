"""Queries of the report parsers over texts rendered from the tables, pages, and document triage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import parsing
from tallyloom.sources import facts
from tallyloom.sources.tables import parquet


def parse_money(spark, sf_dir):
    """Balances written in four styles and read again."""
    c = parquet(spark, sf_dir, "customer").withColumn("v", F.col("c_acctbal").cast(parsing.MONEY))
    plain = F.format_number(F.abs(F.col("v")), 2)
    style = F.when(F.col("v") >= 0, F.concat(F.lit("$"), plain)).when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("($"), plain, F.lit(")"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("-$"), plain)).otherwise(F.concat(F.lit("$-"), plain))
    return c.select("c_custkey", style.alias("t")).select("c_custkey", parsing.money(F.col("t")).cast("double").alias("amount"))


def parse_hours(spark, sf_dir):
    o = parquet(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 300).alias("h"), (F.col("o_custkey") % 60).alias("m"))
    text = F.when(F.col("h") == 0, F.concat(F.col("m"), F.lit("m"))).otherwise(F.concat(F.col("h"), F.lit("h "), F.col("m"), F.lit("m")))
    return o.select("o_orderkey", parsing.hours(text).alias("hours"))


def parse_dates(spark, sf_dir):
    """Dates in four dialects, one of them spreadsheet serials."""
    o = parquet(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format("d", "yyyy-MM-dd")).when(k == 1, F.date_format("d", "M/d/yyyy")).when(k == 2, F.date_format("d", "d MMM yyyy")).otherwise(F.datediff("d", F.lit("1899-12-30").cast("date")).cast("string"))
    return o.select("o_orderkey", parsing.day(text).alias("day"))


def parse_percent(spark, sf_dir):
    """Discounts as fractions or percents; what is no number gives 0."""
    li = parquet(spark, sf_dir, "part").select("p_partkey", "p_size")
    text = F.when(F.col("p_size") % 7 == 0, "n/a").otherwise(F.concat(F.col("p_size").cast("string"), F.lit("%")))
    return li.select("p_partkey", parsing.fraction(parsing.number(text)).alias("fraction"))


def header_normalize(spark, sf_dir):
    """Headers of three spellings that mean one column, with the fingerprint of a sheet of them."""
    p = parquet(spark, sf_dir, "part")
    raw = F.concat(F.lit("  "), F.upper("p_brand"), F.lit("   Total\tSales "))
    return p.select(parsing.header(raw).alias("header")).groupBy("header").agg(F.count("*").alias("n"), F.sha2(F.first("header"), 256).alias("fingerprint"))


#: Words that tell the languages of test documents apart, as signs of dialects.
SIGNS = (("english", (" the ", " and ")), ("spanish", (" que ", " los ")), ("german", (" und ", " der ")))


def pos_detect(spark, sf_dir):
    """Documents by the signs in their first 4000 characters; none or several give no dialect."""
    return parquet(spark, sf_dir, "documents").groupBy(F.coalesce(parsing.dialect(F.col("text"), SIGNS), F.lit("unknown")).alias("dialect")).agg(F.count("*").alias("n_documents"), F.min("doc_id").alias("first_doc"))


def html_text(spark, sf_dir):
    t = parsing.plain_text(F.coalesce("html", F.lit("")))
    return parquet(spark, sf_dir, "pages").select("page_id", F.length(t).cast("long").alias("n_chars"), F.size(F.filter(F.split(t, " "), lambda x: x != "")).cast("long").alias("n_tokens"), F.md5(t).alias("text_md5"))


#: Category labels of the reports and the bucket each counts for.
BUCKETS = (("SMALL", "wax"), ("MEDIUM", "treatment"), ("LARGE", "color"), ("STANDARD", "haircut"), ("ECONOMY", "haircut"), ("PROMO", "retail"))


def bucket_totals(rows: DataFrame, aliases: DataFrame, keys: list[str]) -> DataFrame:
    """Counts and nets of rows(label, net) by bucket; labels without an alias are other."""
    out = rows.join(aliases, "label", "left").withColumn("bucket", F.coalesce("bucket", F.lit("other")))
    return out.groupBy(*keys, "bucket").agg(F.count("*").alias("qty"), F.sum("net").alias("net"))


def category_buckets(spark, sf_dir):
    rows = facts.lines(spark, sf_dir).select("loc_name", F.col("p_type").alias("label"), "net")
    out = bucket_totals(rows, spark.createDataFrame(list(BUCKETS), "label string, bucket string"), ["loc_name"])
    return out.select("loc_name", "bucket", "qty", F.col("net").cast("double").alias("net"))


def unclosed_days(spark, sf_dir):
    """Days named after a marker in rendered notes: distinct, and only within the window."""
    v = facts.visits(spark, sf_dir).groupBy("loc_name").agg(F.transform(F.array_sort(F.collect_set("day")), lambda d: F.date_format(d, "M/d/yyyy")).alias("days"))
    text = F.concat(F.lit("Report 1/1/1990. Unclosed days: "), F.array_join("days", ", "))
    found = parsing.days_after(text, "Unclosed days:")
    return v.select("loc_name", F.size(found).cast("long").alias("n_days"), F.array_max(found).alias("last_day"))


def salon_rows(spark, sf_dir):
    """Employee rows read out of rendered summary sheets, one a location: figures come back as they were written."""
    s = facts.totals(facts.lines(spark, sf_dir), ["stylist_name", "loc_name"])
    letters = F.concat(F.lit("Ann "), F.translate(F.regexp_extract("stylist_name", r"(\d+)", 1), "0123456789", "abcdefghij"))
    line = F.concat_ws(" ", letters, F.concat(F.lit("$"), F.format_number("service", 2)), F.concat(F.lit("$"), F.format_number("product", 2)), F.col("guests").cast("string"), F.col("prod_hours").cast("string"))
    sheet = s.groupBy("loc_name").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("lines")).select("loc_name", F.concat(F.lit("EMPLOYEE SALE DETAILS\nName Service Product Guests Hours\n"), "lines", F.lit("\nTotal 1 2\n")).alias("text"))
    rows = parsing.person_rows(sheet, "text")
    n = lambda i: F.col("numbers")[i].cast("double")
    return rows.select("loc_name", "name", n(0).alias("service"), n(1).alias("product"), n(2).cast("long").alias("guests"), n(3).alias("prod_hours"))


QUERIES = {f.__name__: f for f in (parse_money, parse_hours, parse_dates, parse_percent, header_normalize, pos_detect, html_text, category_buckets, unclosed_days, salon_rows)}

_HEAD = "lower(substr(text, 1, 4000))"
ORACLE = {
    "parse_money": "SELECT c_custkey, c_acctbal::DECIMAL(18,2)::DOUBLE AS amount FROM customer",
    "parse_hours": "SELECT o_orderkey, (o_orderkey % 300)::DOUBLE + (o_custkey % 60)::DOUBLE / 60 AS hours FROM orders",
    "parse_dates": "SELECT o_orderkey, o_orderdate::DATE AS day FROM orders",
    "parse_percent": "SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 0.0 WHEN p_size <= 1 THEN p_size::DOUBLE ELSE p_size::DOUBLE / 100 END AS fraction FROM part",
    "header_normalize": "SELECT lower(p_brand) || ' total sales' AS header, count(*) AS n, sha256(lower(p_brand) || ' total sales') AS fingerprint FROM part GROUP BY lower(p_brand)",
    "pos_detect": f"""WITH d AS (SELECT doc_id, {', '.join(f"coalesce({' OR '.join(f'contains({_HEAD}, {w!r})' for w in words)}, false) AS {n}" for n, words in SIGNS)} FROM documents)
SELECT CASE WHEN english::INT + spanish::INT + german::INT <> 1 THEN 'unknown' WHEN english THEN 'english' WHEN spanish THEN 'spanish' ELSE 'german' END AS dialect, count(*) AS n_documents, min(doc_id) AS first_doc FROM d GROUP BY 1""",
    "html_text": r"""WITH t AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM pages)
SELECT page_id, length(t) AS n_chars, len(list_filter(string_split(t, ' '), lambda x: x <> '')) AS n_tokens, md5(t) AS text_md5 FROM t""",
    "category_buckets": f"""WITH {facts.LINES_SQL} SELECT loc_name, CASE p_type {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in BUCKETS)} ELSE 'other' END AS bucket, count(*) AS qty, sum(net)::DOUBLE AS net FROM lines GROUP BY 1, 2""",
    "unclosed_days": f"""WITH {facts.VISITS_SQL}, d AS (SELECT DISTINCT loc_name, day FROM visits),
p AS (SELECT *, 15 + sum(length(strftime(day, '%-m/%-d/%Y')) + 2) OVER (PARTITION BY loc_name ORDER BY day) - 2 AS ends FROM d)
SELECT loc_name, count(*) AS n_days, max(day) AS last_day FROM p WHERE ends <= 400 GROUP BY 1""",
    "salon_rows": f"""WITH {facts.LINES_SQL}, t AS ({facts.totals_sql('stylist_name, loc_name')})
SELECT loc_name, 'Ann ' || translate(regexp_extract(stylist_name, '(\\d+)', 1), '0123456789', 'abcdefghij') AS name, service::DOUBLE AS service, product::DOUBLE AS product, guests::BIGINT AS guests, prod_hours::DOUBLE AS prod_hours FROM t""",
}
