"""What the third review found, each on the smallest rows that show it."""

import os
from decimal import Decimal
from difflib import SequenceMatcher
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators import grids, manifest, orders, people, stores, summaries, transfers
from tallyloom.sources import facts
from tallyloom.streaming import ingest

FOLDER = "/root/testdata/sf0.001"


def compared(limit):
    """A similarity that does not stand for pairs of which `limit` says that they need no comparing."""

    @F.pandas_udf(T.DoubleType())
    def ratio(new: pd.Series, known: pd.Series) -> pd.Series:
        for a, b in zip(new, known):
            if limit(a, b):
                raise ValueError(f"{a} was compared with {b}")
        return pd.Series([SequenceMatcher(None, a, b).ratio() for a, b in zip(new, known)])

    return ratio.asNondeterministic()


def test_names_with_a_common_start_are_not_all_compared(spark, monkeypatch):
    """a name with one letter too many is looked up, however many known names are like it."""
    known = [f"annmarie {a}{b}{c}aaa" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    k = spark.createDataFrame([("L", x) for x in known], "loc string, name string")
    new = k.select("loc", F.concat(F.substring("name", 1, 4), F.substring("name", 4, 40)).alias("name"))
    monkeypatch.setattr(people, "similarity", compared(lambda a, b: abs(len(a) - len(b)) != 1))
    got = {r["name"]: r.known_name for r in people.best_match(new, k, "loc").collect()}
    assert got == {x[:4] + x[3:]: x for x in known}


def test_best_match_against_brute_force(spark):
    """Names of which a letter is missing, doubled, or changed, ties included."""
    rng = np.random.default_rng(5)
    known = sorted({"".join(rng.choice(list("abc "), rng.integers(1, 24))).strip() for _ in range(120)} - {""})
    new = sorted({y for x in known for y in (x[1:], x[:3] + x[2:], x[:-2] + "c" + x[-1:], x[::-1], x[:4] + x[5:9] + x[10:]) if y})
    want = {}
    for a in new:
        ratio, name = max((1.0 if a == b else SequenceMatcher(None, a, b).ratio(), b) for b in known)
        if ratio >= people.MATCH:
            want[a] = (name, ratio)
    df = lambda names: spark.createDataFrame([("L", x) for x in names], "loc string, name string")
    got = {r["name"]: (r.known_name, r.ratio) for r in people.best_match(df(new), df(known), "loc").collect()}
    assert got == want and len(want) > 100


def test_unlike_names_are_not_compared(spark, monkeypatch):
    """long names that share hardly a group of three letters; no similar pair is lost."""
    rng = np.random.default_rng(6)
    names = ["".join(rng.choice(list("abcdefghijklmnop"), 14)) for _ in range(150)]
    names += [x[:4] + x[3:] for x in names[:40]] + [x[:6] + "q" + x[7:] for x in names[:40]]
    groups = lambda x: {x[i : i + 3] for i in range(len(x) - 2)}
    monkeypatch.setattr(people, "similarity", compared(lambda a, b: len(groups(a) & groups(b)) < 2))
    df = spark.createDataFrame([("L", x) for x in names], "loc string, name string")
    got = {(r["name"], r.known_name) for r in people.similar_pairs(df, df.withColumnRenamed("name", "known_name"), "loc").collect()}
    assert got == {(a, b) for a in names for b in names if SequenceMatcher(None, a, b).ratio() >= people.MATCH} and len(got) > len(names)


def test_names_of_the_same_parts_in_other_orders_are_not_compared(spark, monkeypatch):
    """groups of letters in common are not enough, a piece of the name must stand where it can."""
    parts = ["abcd", "efgh", "ijkl", "mnop"]
    names = ["".join(x) for x in permutations(parts)]
    new = names + [x[:5] + x[6:] for x in names] + [x[:7] + "z" + x[7:] for x in names]
    monkeypatch.setattr(people, "similarity", compared(lambda a, b: SequenceMatcher(None, a, b).ratio() < people.MATCH))
    df = lambda rows, c: spark.createDataFrame([("L", x) for x in rows], f"loc string, {c} string")
    got = {(r["name"], r.known_name) for r in people.similar_pairs(df(new, "name"), df(names, "known_name"), "loc").collect()}
    assert got == {(a, b) for a in new for b in names if SequenceMatcher(None, a, b).ratio() >= people.MATCH} and len(got) == len(new)


def test_similar_pairs_of_every_length_against_brute_force(spark):
    """pieces of names of 1 to 40 letters, of which up to five are missing, added or exchanged."""
    rng = np.random.default_rng(7)
    known = sorted({"".join(rng.choice(list("abcd "), n)) for n in rng.integers(1, 41, 150)})
    new = set(known)
    for x in known:
        y = list(x)
        for _ in range(rng.integers(1, 6)):
            at = rng.integers(0, len(y) + 1)
            y[at : at + rng.integers(0, 2)] = rng.choice(list("abcd "), rng.integers(0, 2))
        new.add("".join(y))
    new = sorted(new - {""})
    df = lambda rows, c: spark.createDataFrame([("L", x) for x in rows], f"loc string, {c} string")
    got = {(r["name"], r.known_name) for r in people.similar_pairs(df(new, "name"), df(known, "known_name"), "loc").collect()}
    assert got == {(a, b) for a in new for b in known if SequenceMatcher(None, a, b).ratio() >= people.MATCH} and len(got) > 200


def test_lines_meet_their_stylists_without_a_sort(spark, capsys):
    """Lines come together by stylist and need no sorting, and groups' rows hold longs."""
    facts.lines(spark, FOLDER).explain()
    plan = capsys.readouterr().out
    assert "ShuffledHashJoin [l_suppkey" in plan
    rows = spark.sql("SELECT * FROM VALUES ('a', 'PROMO', 1.10BD, 2.00BD), ('a', 'SMALL', -3.33BD, NULL), ('a', 'SMALL', NULL, NULL), ('b', 'LARGE', 9999999999999999.99BD, NULL) AS t(k, p_type, net, hours)")
    got = {r.k: r for r in facts.totals(rows.withColumns({c: F.col(c).cast(facts.MONEY) for c in ("net", "hours")}), ["k"]).collect()}
    assert (got["a"].product, got["a"].service, got["a"].wax, got["a"].prod_hours) == (Decimal("1.10"), Decimal("-3.33"), Decimal("-3.33"), Decimal("2.00"))
    assert got["b"].color == Decimal("9999999999999999.99") and got["b"].prod_hours is None


def test_people_of_one_name_count_once(spark):
    """Two managers of one name and location are two rows, and the sums stay those that the text states."""
    text = """Service Net: 30.00
Product Net: 3.00
TIPS COLLECTED AMOUNT
Total 7.00
EMPLOYEE SALE DETAILS
Aaaaaa Mgr mgr
10.00 (12.5%) 3.00 4
4 0.00 -1.00 1.00
Bbb Ccc
0.00 (12.5%) 0.00 0
0 0.00 -1.00 0.00
Aaaaaa Mgr mgr
20.00 (12.5%) 4.00 5
5 0.00 -1.00 2.00
EMPLOYEE PERFORMANCE
Aaaaaa
Mgr
mgr
1
2
3
6.00
5
Aaaaaa
Mgr
mgr
1
2
3
8.00
5
Total 1 2 3 14.00"""
    docs = spark.createDataFrame([("L", "2024-01", text)], "loc_name string, year_month string, text string")
    staff = summaries.sales_and_hours(docs, summaries.DOC)
    rows = [(r.name, float(r.service), None if r.hours is None else float(r.hours), r.flag) for r in staff.orderBy("name", "service").collect()]
    assert rows == [("Aaaaaa Mgr mgr", 10.0, 6.0, None), ("Aaaaaa Mgr mgr", 20.0, 8.0, None), ("Bbb Ccc", 0.0, None, "sale_without_hours")]
    assert all(r.ok for r in summaries.legs(docs, staff, summaries.DOC).collect())


def test_runs_without_files_are_runs_of_the_log(spark, tmp_path):
    """tables without the years that the first and third run wait for give three rows all the same."""
    for t in ("region", "nation", "supplier", "part"):
        os.symlink(f"{FOLDER}/{t}.parquet", tmp_path / f"{t}.parquet")
    late = spark.read.parquet(f"{FOLDER}/lineitem.parquet").where("l_shipdate BETWEEN '1995-06-01' AND '1996-03-01'")
    late.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted(manifest.manifest_runs(spark, str(tmp_path)).collect())
    assert [r.run for r in got] == [1, 2, 3] and [sum(r[1:4]) > 0 for r in got] == [False, True, False]
    assert stores.current_number(spark, manifest._three_runs(spark, str(tmp_path))[0]) == 3


def test_parts_of_the_report_source_are_whole(spark, tmp_path, monkeypatch):
    """Files before and after a week in one query, each once."""
    from tallyloom.operators import parsed

    for week in ("1994-12-01", "1995-01-01", "1996-02-01"):
        (tmp_path / "in" / week / "L").mkdir(parents=True)
        (tmp_path / "in" / week / "L" / "r.txt").write_text(f"Service Net: {week[:4]}.00")
    monkeypatch.setattr(parsed, "_report_folder", lambda *_: str(tmp_path))
    got = sorted((r.year_month, r.service) for r in parsed.report_source(spark, FOLDER).collect())
    assert got == [("1994-12", 1994.0), ("1995-01", 1995.0), ("1996-02", 1996.0)]


def test_lost_categories_from_an_average_of_two(spark):
    """the limit that the query was made with; there are such weeks in the tables."""
    from tallyloom.operators import trust

    out = trust.zero_vs_baseline(spark, "/root/testdata/sf0.01").select("baseline").toPandas()
    assert len(out) > 0 and out.baseline.between(2, 5).any()


def test_paged_providers_read_the_tables_once(spark):
    """the plan that is run holds what was stored, not the sheets' making again for each step that reads them."""
    for query in (grids.paged_providers, grids.provider_contract):
        files = query(spark, FOLDER)
        assert not any("lineitem" in f for f in files.inputFiles()) and files.count() > 0


def test_tasks_of_the_pattern_grow_with_the_orders(spark, monkeypatch):
    """a task has a bounded number of orders' lines; a week without rows of the person gives none, nor does one that is null."""
    monkeypatch.setattr(facts, "ORDERS", 100, raising=False)
    assert transfers.multi_location_pattern(spark, FOLDER).rdd.getNumPartitions() == -(-spark.read.parquet(f"{FOLDER}/orders.parquet").count() // 100)
    rows = spark.sql("SELECT * FROM VALUES ('p', DATE '2024-01-07', 'A', 1), ('p', DATE '2024-01-28', 'B', 2), ('p', DATE '2024-02-04', 'B', 1), ('p', NULL, 'A', 1) AS t(person, week, loc_name, n)")
    got = {str(r.week): (r.primary_location, r.split) for r in transfers.location_pattern(rows).collect()}
    assert got == {"2024-01-07": ("A", "A:1000"), "2024-01-28": ("B", "A:333;B:666"), "2024-02-04": ("B", "B:1000")}


def test_tasks_of_places_as_known_grow_with_the_moves(spark, monkeypatch):
    """questions and versions meet by person in tasks of a bounded number of moves."""
    monkeypatch.setattr(facts, "ORDERS", 100, raising=False)
    out = orders.place_as_known(spark, FOLDER)
    assert out.rdd.getNumPartitions() == -(-out.count() // 2 // 100)


def test_only_corrections_look_up_what_they_correct(spark, monkeypatch):
    """rows that correct nothing do not all meet in one task by their null."""
    monkeypatch.setattr(facts, "ORDERS", 100, raising=False)
    log = spark.range(2000).selectExpr("concat('t', id, if(id < 1000, '', '-c')) AS event_id", "if(id < 1000, null, concat('t', id - 1000)) AS corrects", "id % 1000 AS person", "id % 1000 AS visit", "DATE '2024-01-01' AS day", "if(id < 1000, 1, 2) AS version", "'active' AS status", "double(id % 1000) AS score", "'wrong_date' AS kind", "'L' AS corrected_loc", "DATE '2024-01-01' AS corrected_day")
    out = transfers.audit_trail(log)
    assert out.rdd.getNumPartitions() == 20 and {(r.person, r.place, r.score, r.original_score) for r in out.collect()} == {x for i in range(1000) for x in ((i, 1, float(i), None), (i, 2, None, float(i)))}
    assert max(out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) < 200


def test_times_in_the_state_are_numbers(spark, tmp_path):
    """a key's rows are not made into time objects and texts one by one; microseconds stay."""
    day = "TIMESTAMP '2024-01-0{} 10:00:00.00000{}'"
    rows = ", ".join(f"('p', '{place}', {day.format(d, us)})" for d, us, place in ((1, 1, "A"), (2, 2, "B"), (2, 3, "B"), (9, 9, "C")))
    spark.sql(f"SELECT * FROM VALUES {rows} AS t(who, place, ts)").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("who string, place string, ts timestamp").parquet(f"{tmp_path}/in")
    out = ingest.timed_grace_period(stream, "who", "place", "ts")
    assert "since,LongType" in out._jdf.queryExecution().analyzed().toString()
    out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(out.schema).parquet(f"{tmp_path}/out").selectExpr("*", "unix_micros(seen) % 1000000 AS us").collect()
    assert [(r.from_place, r.to_place, r.how, r.us) for r in got] == [("A", "B", "confirmed", 3)]


def test_tasks_that_read_texts_grow_with_the_lines(spark, monkeypatch):
    """F32: texts are made and read in tasks of a bounded number of lines."""
    monkeypatch.setattr(facts, "LINES", 200, raising=False)
    assert summaries._texts(spark, FOLDER).rdd.getNumPartitions() == -(-spark.read.parquet(f"{FOLDER}/lineitem.parquet").count() // 200)
