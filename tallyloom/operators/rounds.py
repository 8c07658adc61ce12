"""Rules that decide one row after another, as rounds of joins in which every row that depends on nothing undecided is decided at once.

A round is a join and an aggregation over the pairs still open, stored in the shared folder. There are as many rounds as the longest chain
of rows that wait for each other, not as many as rows; only whether a round decided anything reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.work import stored, work_folder


def first_wins(pairs: DataFrame, keys: list[str], known: str, name: str = "name") -> DataFrame:
    """(keys, name, is_first) of every name in pairs(keys, name, known): a name is a first one if none of its known names is one.

    pairs must lead from later names to earlier ones of a total order. This is what going through the names in order gives, each joining
    an earlier first one if there is any: the lexicographically first independent set. Null names or keys take no part.
    """
    folder = work_folder(pairs.sparkSession, "first-wins")
    open_ = stored(pairs.select(*keys, name, known).na.drop().distinct(), folder)
    later, earlier = open_.select(*keys, name).distinct(), open_.select(*keys, F.col(known).alias(name)).distinct()
    new = stored(earlier.join(later, [*keys, name], "left_anti").withColumn("is_first", F.lit(True)), folder)
    decided = [new]
    while not new.isEmpty():
        told = open_.join(new.withColumnsRenamed({name: known, "is_first": "_first"}), [*keys, known], "left")
        told = stored(told, folder)
        per = told.groupBy(*keys, name).agg(F.bool_or(F.coalesce("_first", F.lit(False))).alias("_any"), F.every(F.col("_first").isNotNull()).alias("_all"))
        new = stored(per.where("_any OR _all").select(*keys, name, (~F.col("_any")).alias("is_first")), folder)
        decided.append(new)
        open_ = told.where("_first IS NULL").drop("_first").join(new, [*keys, name], "left_anti")  # pairs with names that are no first ones say nothing more
    return reduce(DataFrame.unionByName, decided)


def claims(pairs: DataFrame, left: str, right: str, left_order: Column, right_order: Column) -> DataFrame:
    """(left, right), each in one pair at most: what comes of the lefts choosing in order, each its first free right.

    pairs holds who may choose what; orders are over its columns, and ties go to the smaller id. A pair is settled in the round in which
    each side is the other's first among those still free.
    """
    folder = work_folder(pairs.sparkSession, "claims")
    open_ = pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    open_ = stored(open_.select(left, right, F.struct(left_order, F.col(left)).alias("_l"), F.struct(right_order, F.col(right)).alias("_r")), folder)
    settled = []
    while True:
        wants = open_.groupBy(left).agg(F.min_by(right, "_r").alias(right))
        gives = open_.groupBy(right).agg(F.min_by(left, "_l").alias(left))
        new = stored(wants.join(gives, [left, right]).select(left, right), folder)
        settled.append(new)
        if new.isEmpty():
            return reduce(DataFrame.unionByName, settled)
        open_ = stored(open_.join(new.select(left), left, "left_anti").join(new.select(right), right, "left_anti").select(open_.columns), folder)
