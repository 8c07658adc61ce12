"""Pieces of texts that are worked on once each: corpus counts, the frequent ones, and weighted sums joined back to the texts.

What cuts texts is a function without arguments, called once a task, that returns an object whose tally(texts) goes through an iterator
of texts and yields arrays of pieces with how often they occur. It must be picklable.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import hot_keys, join_skewed, stored

#: Most frequent pieces that are broadcast, each of at most SHORT characters.
OFTEN, SHORT = 200_000, 32


def keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """(_key, text) of the texts that are not empty; equal texts have equal keys."""
    return docs.where(F.length(text_col) > 0).select(F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("_key"), F.col(text_col).alias("text"))


def counted(texts: DataFrame, load: Callable) -> DataFrame:
    """(piece, n): how often each piece occurs in all of texts(text). Tasks add up what they have before the shuffle."""

    def run(batches):
        for pieces, n in load().tally(t.as_py() for b in batches for t in b.column(0)):
            yield pa.RecordBatch.from_arrays([pieces, n], ["piece", "n"])

    return texts.select("text").mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def often(table: DataFrame, most: int = OFTEN) -> DataFrame:
    """The rows of table(piece, n, ...) with the most frequent pieces, at most `most`, which can therefore be broadcast.

    The least count is one of sixteen steps to a doubling, chosen from how many pieces lie in each: about a thousand numbers reach the
    driver.
    """
    step = F.floor(F.log2("n") * 16).cast("int")
    short = table.where(F.length("piece") <= SHORT) if dict(table.dtypes)["piece"] == "string" else table
    steps = dict(short.groupBy(step.alias("d")).agg(F.count("*").alias("c")).collect())
    least, total = max(steps, default=0) + 1, 0
    while least > 0 and total + steps.get(least - 1, 0) <= most:
        least -= 1
        total += steps.get(least, 0)
    return short.where(step >= least)


def weighed(freq: DataFrame, common: DataFrame, rest: DataFrame | None, values: list[str], label: str) -> DataFrame:
    """(_key, copies, values): for each key of freq(_key, pieces, times) the sums of the pieces' values times their frequencies, of one of its rows.

    common(piece, values) is broadcast, so its bound must be known; pieces that it lacks meet rest(piece, values) by a shuffle, or count
    nothing where rest is None. Rows of a key must be equal, and are divided out. A task adds up the common pieces of a row before
    anything is shuffled, so only one row a text, and one a rare piece of it, travel.
    """
    rows = freq.select("_key", F.posexplode(F.arrays_zip("pieces", "times")).alias("at", "x")).select("_key", "at", F.col("x.pieces").alias("piece"), F.col("x.times").alias("n"))
    rows = rows.join(F.broadcast(common.select("piece", *values, F.lit(True).alias("_known"))), "piece", "left")
    sums = [F.sum(F.coalesce(F.col(v) * F.col("n"), F.lit(0))).cast("long").alias(v) for v in values]
    if rest is None:
        out = rows.groupBy("_key").agg(F.count_if(F.col("at") == 0).alias("copies"), *sums)
    else:
        rare = F.when(F.col("_known").isNull(), F.col("piece"))
        part = stored(rows.groupBy("_key", rare.alias("piece")).agg(F.sum("n").alias("n"), F.count_if(F.col("at") == 0).alias("copies"), *sums), label)
        met = part.where("piece IS NOT NULL").drop(*values).join(rest.select("piece", *values), "piece")
        met = met.select("_key", "copies", *((F.col(v) * F.col("n")).alias(v) for v in values))
        both = part.where("piece IS NULL").select("_key", "copies", *values).unionByName(met)
        out = both.groupBy("_key").agg(*(F.sum(v).alias(v) for v in ("copies", *values)))
    return out.select("_key", "copies", *(F.expr(f"{v} div copies").alias(v) for v in values))


def met(rows: DataFrame, totals: DataFrame, copies: str = "copies") -> DataFrame:
    """rows(_key, ...) with the columns of totals(_key, copies, ...), null where _key is; keys of very many rows are met by broadcast."""
    totals = stored(totals, "totals")
    side = totals.drop(copies)
    found = join_skewed(rows.where("_key IS NOT NULL"), side, ["_key"], hot_keys(totals, ["_key"], n=copies), "left")
    none = rows.where("_key IS NULL").select("*", *(F.lit(None).cast(t).alias(n) for n, t in side.dtypes if n != "_key"))
    return found.select(none.columns).unionByName(none)
