"""Ranks and running sums over a whole table or a very long key, without a window that one task has to go through.

Rows are dealt by ranges of their order, so that each part holds a stretch of it; a part is numbered and summed by itself, and what stands
before it is added from the sums of all parts, of which there are as many as parts and keys in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources import facts
from tallyloom.sources.tables import parquet
from tallyloom.sources.work import stored, work_folder


def running(df: DataFrame, keys: list[str], order: list[Column], sums: dict[str, str], number: str = "place", parts: int | None = None) -> DataFrame:
    """df with the place of each row within its key, from 1, and for each name in sums the sum of that column over the rows up to it.

    order must be total within a key, or rows that are equal in it stand in an undefined order. Nulls count as nothing in a sum, which is
    null as long as there were only nulls; null keys are a key. An empty table gives an empty result. Sums have the type that Spark's sum
    gives; only sums of exact types do not depend on how rows were dealt.
    """
    by = [F.col(k).asc() for k in keys] + list(order)
    dealt = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    rows = stored(dealt.withColumn("_part", F.spark_partition_id()), work_folder(df.sparkSession, "ranges"))
    here = Window.partitionBy("_part", *keys).orderBy(*order)
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = rows.withColumns({"_n": F.row_number().over(here).cast("long"), **{f"_s_{s}": F.sum(c).over(so_far) for s, c in sums.items()}})
    total = rows.groupBy("_part", *keys).agg(F.count("*").alias("_count"), *(F.sum(c).alias(f"_t_{s}") for s, c in sums.items()))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select(F.col("_part").alias("_p"), *(F.col(k).alias(f"_k_{k}") for k in keys), F.sum("_count").over(before).alias("_before"), *(F.sum(f"_t_{s}").over(before).alias(f"_b_{s}") for s in sums))
    on = F.col("_part") == F.col("_p")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    out = own.join(total, on)
    zero = lambda s: F.when(F.col(f"_s_{s}").isNotNull() | F.col(f"_b_{s}").isNotNull(), F.coalesce(f"_s_{s}", F.lit(0)) + F.coalesce(f"_b_{s}", F.lit(0)))
    return out.select(*df.columns, (F.col("_n") + F.coalesce("_before", F.lit(0))).alias(number), *(zero(s).alias(s) for s in sums))


def global_rank(df: DataFrame, order: list[Column], number: str = "place") -> DataFrame:
    """df with each row's place in the order over the whole table."""
    return running(df, [], order, {}, number)


def order_places(spark, sf_dir):
    """Every order's place by its worth, over the whole table."""
    o = parquet(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast(facts.MONEY).alias("worth"))
    return global_rank(o, [F.col("worth").desc(), F.col("o_orderkey").asc()]).select("o_orderkey", "place")


def running_revenue(spark, sf_dir):
    """Each region's orders by day, their place and the revenue so far: five keys for the whole table."""
    v = facts.visits(spark, sf_dir).join(facts.places(spark, sf_dir).select("loc_name", "manager").distinct(), "loc_name")
    out = running(v.select("manager", "visit", "day", "revenue"), ["manager"], [F.col("day").asc(), F.col("visit").asc()], {"so_far": "revenue"})
    return out.select("manager", "visit", "place", F.col("so_far").cast("double").alias("so_far"))


QUERIES = {f.__name__: f for f in (order_places, running_revenue)}
ORACLE = {
    "order_places": "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice::DECIMAL(18,2) DESC, o_orderkey) AS place FROM orders",
    "running_revenue": f"""WITH {facts.VISITS_SQL}, p AS (SELECT DISTINCT loc_name, manager FROM places)
SELECT manager, visit, row_number() OVER w AS place, (sum(revenue) OVER w)::DOUBLE AS so_far FROM visits JOIN p USING (loc_name) WINDOW w AS (PARTITION BY manager ORDER BY day, visit ROWS UNBOUNDED PRECEDING)""",
}
