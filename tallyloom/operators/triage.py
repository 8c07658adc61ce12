"""Message triage: the first noise rule that fits, mentions, urgency lists and categories in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources.tables import parquet

NONE = "real"


def first_rule(rules: list[tuple[Column, str]], none: str = NONE) -> Column:
    """The name of the first rule that holds."""
    out = None
    for holds, name in rules:
        out = F.when(holds, name) if out is None else out.when(holds, name)
    return out.otherwise(none)


def noise_rules(trusted: tuple[str, ...], blocked: tuple[str, ...], domains: tuple[str, ...], subject: str, sender: str) -> list[tuple[Column, str]]:
    """Trusted senders first, then list headers, blocked senders and domains, subject and sender patterns. Columns: sender, subject, has_unsubscribe, has_list_id."""
    c = lambda n: F.lower(F.coalesce(F.col(n), F.lit("")))
    return [
        (c("sender").isin(*trusted), NONE), (F.col("has_unsubscribe"), "unsubscribe header"), (F.col("has_list_id"), "mailing list"), (c("sender").isin(*blocked), "blocked sender"),
        (F.element_at(F.split(c("sender"), "@"), -1).isin(*domains), "blocked domain"), (c("subject").rlike(subject), "subject"), (c("sender").rlike(sender), "automated sender"),
    ]


def mentions(docs: DataFrame, names: list[str], text: str) -> DataFrame:
    """(name, n): documents that contain each of a few names, taken in one pass over the texts."""
    found = F.filter(F.array(*map(F.lit, names)), lambda n: F.contains(F.col(text), n))
    return docs.select(F.explode(found).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


def top_per(df: DataFrame, within: list[str], n: int, *order) -> DataFrame:
    """The first n rows of each group: urgent ones, filled up with others as the order says."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).where(F.col("place") <= n)


def _messages(spark, sf_dir) -> DataFrame:
    c = parquet(spark, sf_dir, "conversations")
    sender = F.concat(F.col("role"), (F.col("conv_id") % 20).cast("string"), F.when(F.col("turn") % 5 == 3, "@bulk.example").otherwise("@mail.example"))
    return c.select("conv_id", "turn", sender.alias("sender"), F.substring("text", 1, 60).alias("subject"), (F.col("conv_id") % 17 == 0).alias("has_unsubscribe"), (F.col("conv_id") % 13 == 0).alias("has_list_id"), F.length("text").alias("size"))


def _judged(spark, sf_dir) -> DataFrame:
    rules = noise_rules(("user0@mail.example",), ("assistant1@mail.example",), ("bulk.example",), r"(the|ung) ", r"^system")
    return _messages(spark, sf_dir).withColumn("reason", first_rule(rules))


def noise_filter_first_match(spark, sf_dir):
    return _judged(spark, sf_dir).groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("conv_id").alias("n_conversations"))


def noise_ledger(spark, sf_dir):
    """The first reason each sender was noise for."""
    rows = _judged(spark, sf_dir).where(F.col("reason") != NONE)
    return rows.groupBy("sender").agg(F.min_by("reason", F.struct("conv_id", "turn")).alias("reason"), F.count("*").alias("n_noise"))


NAMES = ("thing", "cación", "heit", "eau", "tion", "worthless", "zzz")


def location_mentions(spark, sf_dir):
    return mentions(parquet(spark, sf_dir, "documents"), list(NAMES), "text")


def _categorised(spark, sf_dir) -> DataFrame:
    m = _judged(spark, sf_dir).where(F.col("reason") == NONE)
    urgency = F.when(F.col("size") > 800, 1).when(F.col("size") > 300, 2).otherwise(3)
    return m.select("conv_id", "turn", "sender", "size", urgency.cast("long").alias("urgency"), F.element_at(F.array(*map(F.lit, CATEGORIES)), (F.col("size") % 4 + 1).cast("int")).alias("category"))


CATEGORIES = ("schedule", "staff", "inventory", "other")


def top3_with_fill(spark, sf_dir):
    """Each conversation's three most urgent messages, urgent ones first."""
    rows = top_per(_categorised(spark, sf_dir), ["conv_id"], 3, "urgency", "turn")
    return rows.select("conv_id", "turn", "sender", "urgency", F.col("place").cast("long").alias("place"))


def category_counts(spark, sf_dir):
    """Counts in the categories' own order, empty ones included."""
    order = spark.createDataFrame([(c, i + 1) for i, c in enumerate((*CATEGORIES, "legal"))], "category string, place long")
    n = _categorised(spark, sf_dir).groupBy("category").agg(F.count("*").alias("n"), F.count_if(F.col("urgency") == 1).alias("n_urgent"))
    return order.join(n, "category", "left").select("category", "place", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_urgent", F.lit(0)).alias("n_urgent"))


QUERIES = {f.__name__: f for f in (noise_filter_first_match, noise_ledger, location_mentions, top3_with_fill, category_counts)}

_J = """m AS (SELECT conv_id, turn, role || (conv_id % 20)::VARCHAR || CASE WHEN turn % 5 = 3 THEN '@bulk.example' ELSE '@mail.example' END AS sender, substr(text, 1, 60) AS subject, conv_id % 17 = 0 AS u, conv_id % 13 = 0 AS l, length(text) AS size FROM conversations),
j AS (SELECT *, CASE WHEN sender = 'user0@mail.example' THEN 'real' WHEN u THEN 'unsubscribe header' WHEN l THEN 'mailing list' WHEN sender = 'assistant1@mail.example' THEN 'blocked sender' WHEN sender LIKE '%@bulk.example' THEN 'blocked domain'
  WHEN regexp_matches(lower(subject), '(the|ung) ') THEN 'subject' WHEN sender LIKE 'system%' THEN 'automated sender' ELSE 'real' END AS reason FROM m)"""
_C = f"""{_J}, c AS (SELECT conv_id, turn, sender, size, CASE WHEN size > 800 THEN 1 WHEN size > 300 THEN 2 ELSE 3 END::BIGINT AS urgency, {list(CATEGORIES)}[(size % 4) + 1] AS category FROM j WHERE reason = 'real')"""
ORACLE = {
    "noise_filter_first_match": f"WITH {_J} SELECT reason, count(*) AS n, count(DISTINCT conv_id) AS n_conversations FROM j GROUP BY 1",
    "noise_ledger": f"WITH {_J} SELECT sender, arg_min(reason, (conv_id, turn)) AS reason, count(*) AS n_noise FROM j WHERE reason <> 'real' GROUP BY 1",
    "location_mentions": f"SELECT name, count(*) AS n FROM (SELECT unnest({list(NAMES)}) AS name) JOIN documents ON contains(text, name) GROUP BY 1",
    "top3_with_fill": f"WITH {_C} SELECT conv_id, turn, sender, urgency, row_number() OVER (PARTITION BY conv_id ORDER BY urgency, turn)::BIGINT AS place FROM c QUALIFY place <= 3",
    "category_counts": f"WITH {_C}, o AS (SELECT unnest({[*CATEGORIES, 'legal']}) AS category, unnest(range(1, 6)) AS place) SELECT o.category, place, count(c.category) AS n, count(c.category) FILTER (urgency = 1) AS n_urgent FROM o LEFT JOIN c ON o.category = c.category GROUP BY ALL",
}
