"""The coverage helpers on small cases: nulls, blanks, ties and gaps."""

from datetime import date

from pyspark.sql import functions as F

from tallyloom.operators import coverage


def test_missing_periods_are_clipped_at_months(spark):
    rows = [("a", date(2026, 4, 26)), ("a", date(2026, 5, 10)), ("a", date(2026, 5, 10)), ("b", date(2026, 5, 3))]
    got = coverage.missing_periods(spark.createDataFrame(rows, "who string, week date"), "who", "week")
    assert sorted(map(tuple, got.collect())) == [("a", date(2026, 4, 30)), ("a", date(2026, 5, 3))]


def test_row_errors(spark):
    rows = [(1, "1.00", "2.00", "3.02"), (1, "1.00", "2.00", "3.03"), (None, "-1.00", "2.00", "1.00"), (-1, None, "2.00", "9.00")]
    df = spark.createDataFrame(rows, "n int, a string, b string, t string").withColumns({c: F.col(c).cast("decimal(18,2)") for c in "abt"})
    got = [r[0] for r in df.select(coverage.row_errors(["n"], ["n", "a"], ["a", "b"], "t")).collect()]
    assert got == ["", "total", "missing n; negative a", "negative n"]


def test_roles_and_aliases(spark):
    names = ["Grand   Total", "Franchise OWNER", "STYLIST", "JJ Abe", "", " ", None, "ann lee"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(coverage.is_role(F.col("n"))).collect()] == [True, True, True, False, False, False, None, False]
    urls = spark.createDataFrame([("http://WWW.example.org",), ("http://my.example.net",), ("x.net",), ("",), (None,)], "u string")
    assert [r[0] for r in urls.select(coverage.longest_alias(F.col("u"), coverage.PLACES)).collect()] == ["head office", "franchise", "network", None, None]
