"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

Each source gets a mean repetition rate; each document draws its count from a Poisson distribution of that mean by inverting the
distribution at a number hashed from its id and a seed, so a rerun, or a task run again, draws the same. Documents are exploded by
their counts and shuffled by a hash of (seed, id, copy), which also deals a hot source evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import hash_52, hot_keys, join_skewed, stored, table

SEED = "mix-1"
#: Without given weights a source's target weight is (its documents) ** POWER.
POWER = 0.5
#: The distribution is inverted up to this many standard deviations, and a few counts, above its mean: a tail below 2**-52.
REACH = 10
#: So many sources' distributions are broadcast at most, 750 numbers each; beyond that only those of hot sources are, and the others meet by a shuffle.
SOURCES = 10_000
#: Up to this mean exp(-rate) is still exact; a larger one is drawn as the sum of several counts of equal means.
MEAN = 500


def source_rates(docs: DataFrame, source_col: str = "source", weights: DataFrame | None = None, total: float | None = None, power: float = POWER) -> DataFrame:
    """(source, n, rate): documents and mean repetition rate of every source.

    rate = total * weight share / n; total defaults to the number of documents. weights(source, weight) gives target weights, absent
    sources and null or negative weights count as 0; by default weights are n ** power. Null is a source like any other.
    """
    n = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        n = n.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(power))))
    else:
        given = weights.groupBy(F.col("source").alias("s")).agg(F.max("weight").cast("double").alias("w"))
        n = n.join(given, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("w", F.greatest(F.coalesce("w", F.lit(0.0)), F.lit(0.0))).drop("s")
    whole = n.agg(F.sum("w").alias("w"), F.sum("n").alias("n"))
    want = F.lit(float(total)) if total is not None else whole.select("n").scalar().cast("double")
    return n.select("source", "n", F.coalesce(want * F.try_divide(F.col("w"), whole.select("w").scalar()) / F.col("n"), F.lit(0.0)).alias("rate"))


def poisson_steps(rate: Column) -> Column:
    """Poisson probabilities of 0, 1, 2, ... added up, as an array. Means up to MEAN."""
    top = F.ceil(rate + REACH * F.sqrt(rate) + 20).cast("int")
    first = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps"))

    def step(a, k):
        p = a["p"] * rate / k
        return F.struct(p.alias("p"), (a["sum"] + p).alias("sum"), F.concat(a["steps"], F.array(a["sum"] + p)).alias("steps"))

    return F.aggregate(F.sequence(F.lit(1), top), first, step)["steps"]


def replication_counts(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: str = SEED, **how) -> DataFrame:
    """(d, id, copies): each row of docs as a struct, its id as text, and its Poisson count. Rows with equal ids draw equal counts; a null id draws as the text 'null'.

    A rate above MEAN is drawn as the sum of independent counts, each of an equal part of it; that is Poisson too.
    """
    rates = stored(source_rates(docs, source_col, **how), "rates")
    rates = rates.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MEAN)).cast("int"))
    steps = rates.select(F.col("source").alias("s"), "draws", poisson_steps(F.col("rate") / F.col("draws")).alias("steps"))
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    steps = steps.withColumn("key", key("s"))
    rows = docs.select(F.struct(*docs.columns).alias("d"), key(source_col).alias("key"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"))
    even = lambda *parts: hash_52(F.lit(seed), *parts, F.col("id")) / F.lit(float(2**52))
    rows = rows.withColumn("u", even())
    if rates.count() <= SOURCES:
        rows = rows.join(F.broadcast(steps), "key", "left")
    else:
        rows = join_skewed(rows, steps, ["key"], hot_keys(rates.select(key("source").alias("key"), "n"), ["key"]), "left")
    count = lambda u: F.size(F.filter("steps", lambda s: s <= u))
    more = F.transform(F.sequence(F.lit(2), F.col("draws")), lambda i: even(F.lit("draw"), i.cast("string")))
    more = F.aggregate(more, F.lit(0), lambda n, u: n + count(u))
    return rows.select("d", "id", (count(F.col("u")) + F.when(F.col("draws") > 1, more).otherwise(0)).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: str = SEED, **how) -> DataFrame:
    """docs replicated to the target weights and shuffled globally, with copy_no (from 1) and shuffle_key.

    Keeps the columns of docs; a column of docs called copy_no or shuffle_key is replaced. Counts of 0 leave a document out: that is
    the method's down-weighting, and an empty table gives an empty result.
    """
    docs = docs.drop("copy_no", "shuffle_key")
    rows = replication_counts(docs, id_col, source_col, seed, **how).where("copies > 0").select("d", "id", F.explode(F.expr("sequence(1, copies)")).alias("copy_no"))
    rows = rows.select("d.*", "copy_no", hash_52(F.lit(seed), F.lit("order"), F.col("id"), F.col("copy_no").cast("string")).alias("shuffle_key"))
    return rows.repartition("shuffle_key").sortWithinPartitions("shuffle_key", id_col, "copy_no")


def op2_poisson_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))


QUERIES = {"op2_poisson_mixing": op2_poisson_mixing}
ORACLE = {
    "op2_poisson_mixing": f"""
WITH RECURSIVE n AS (SELECT source, count(*) AS n, sqrt(count(*)::DOUBLE) AS w FROM documents GROUP BY source),
whole AS (SELECT source, (SELECT sum(n) FROM n)::DOUBLE * (w / (SELECT sum(w) FROM n)) / n AS rate FROM n),
rates AS (SELECT source, greatest(1, ceil(rate / {MEAN}))::INTEGER AS draws, rate / greatest(1, ceil(rate / {MEAN})) AS rate FROM whole),
steps(source, rate, k, p, total) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), total + p * rate / (k + 1) FROM steps WHERE k < ceil(rate + {REACH} * sqrt(rate) + 20)),
numbered AS (SELECT *, row_number() OVER () AS row FROM documents),
draws AS (SELECT row, d.source, coalesce(doc_id::VARCHAR, 'null') AS id, unnest(range(1, draws + 1)) AS i FROM numbered d JOIN rates r ON r.source IS NOT DISTINCT FROM d.source),
drawn AS (SELECT *, ('0x' || substr(md5('{SEED}|' || CASE WHEN i > 1 THEN 'draw|' || i || '|' ELSE '' END || id), 1, 13))::BIGINT / {2**52}.0::DOUBLE AS u FROM draws),
counts AS (SELECT row, sum((SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND s.total <= d.u)) AS copies FROM drawn d GROUP BY row),
copies AS (SELECT d.*, unnest(range(1, copies::BIGINT + 1))::INTEGER AS copy_no FROM numbered d JOIN counts USING (row))
SELECT doc_id, text, lang, source, n_chars, copy_no,
  ('0x' || substr(md5('{SEED}|order|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy_no), 1, 13))::BIGINT AS shuffle_key
FROM copies"""
}
