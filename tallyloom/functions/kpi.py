"""KPI algebra: additive figures may be added and differenced, ratios are always computed anew from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a ratio with denominator zero or null is: 0.0 in weekly figures, null in reports.
ZERO, NULL = "zero", "null"


def ratio(a: Column, b: Column, empty: str = ZERO) -> Column:
    out = F.try_divide(a.cast("double"), b.cast("double"))
    return F.coalesce(out, F.lit(0.0)) if empty == ZERO else out


def rounded(c: Column, digits: int) -> Column:
    """Halves up, by plain arithmetic on doubles, so that every engine rounds alike."""
    return F.floor(c * float(10**digits) + 0.5) / float(10**digits)


def rounded_sql(x: str, digits: int) -> str:
    return f"floor(({x}) * {10**digits}.0::DOUBLE + 0.5::DOUBLE) / {10**digits}.0::DOUBLE"


def mean(c: Column) -> Column:
    """Aggregate: the mean of doubles from a sum of whole millionths, which does not depend on the order of rows."""
    return F.sum(millionths(c)).cast("double") / 1e6 / F.count(c)


def millionths(c: Column) -> Column:
    return F.floor(c * 1e6 + 0.5).cast("long")


def mean_sql(x: str, where: str | None = None) -> str:
    only = f" FILTER ({where})" if where else ""
    return f"(sum({millionths_sql(x)}){only}::DOUBLE / 1e6::DOUBLE / count({x}){only})"


def millionths_sql(x: str) -> str:
    return f"floor(({x}) * 1e6::DOUBLE + 0.5::DOUBLE)::BIGINT"


# name, numerator, denominator
LOCATION_RATIOS = (
    ("product_pct", "product", "total_sales"), ("ppg", "product", "guests"), ("pph", "service", "prod_hours"), ("avg_ticket", "total_sales", "guests"),
    ("wax_pct", "wax_count", "guests"), ("color_pct", "color", "service"), ("treat_pct", "treat_count", "guests"),
)
STYLIST_RATIOS = tuple(r for r in LOCATION_RATIOS if r[0] in ("product_pct", "ppg", "pph", "avg_ticket"))


def with_ratios(df: DataFrame, ratios=LOCATION_RATIOS, empty: str = ZERO) -> DataFrame:
    """df with total_sales (service and product) and the ratios."""
    df = df.withColumn("total_sales", F.col("service") + F.col("product"))
    return df.withColumns({n: ratio(F.col(a), F.col(b), empty) for n, a, b in ratios})


def plain(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns with decimals as doubles and counts as 64-bit integers, for results that any engine can compare."""
    kinds = dict(df.dtypes)
    cast = lambda c: F.col(c).cast("double") if kinds[c].startswith("decimal") else F.col(c).cast("long") if kinds[c] == "int" else F.col(c)
    return df.select(*(cast(c).alias(c) for c in columns))


def ratios_sql(ratios=LOCATION_RATIOS, empty: str = ZERO) -> str:
    """The ratios as SQL over additive columns; total_sales is spelt out."""
    x = lambda c: "(service + product)" if c == "total_sales" else c
    one = "coalesce({a}::DOUBLE / nullif({b}::DOUBLE, 0), 0.0) AS {n}" if empty == ZERO else "{a}::DOUBLE / nullif({b}::DOUBLE, 0) AS {n}"
    return ", ".join(one.format(a=x(a), b=x(b), n=n) for n, a, b in ratios)


MONEY_SQL = "guests::BIGINT AS guests, service::DOUBLE AS service, product::DOUBLE AS product, (service + product)::DOUBLE AS total_sales, prod_hours::DOUBLE AS prod_hours"
FIGURES = ["guests", "service", "product", "total_sales", "prod_hours"]
ALL_RATIOS = [r[0] for r in LOCATION_RATIOS]
