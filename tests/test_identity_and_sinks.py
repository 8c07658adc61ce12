"""Identity against brute force, token rows, gates, and sinks that fail between their steps."""

import datetime as dt
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import grids, identity, ledger, people, stores, summaries, verify
from tallyloom.streaming import ingest


def names(n, seed=3):
    """Made-up names, many of them close to another."""
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list("abcdeo rs"), rng.integers(1, 14))).strip() for _ in range(n)]
    every = {" ".join(x.split()) for b in base for x in (b, b[:3] + b[2:], b[1:] + "a", b[::-1])}
    return sorted(x for x in every if x and "sr" not in x.split())  # a suffix, which names don't keep


def test_similar_pairs_against_brute_force(spark):
    known = names(60)
    df = spark.createDataFrame([("L", x) for x in known], "loc string, name string")
    got = {(r.name, r.known_name): r.ratio for r in people.similar_pairs(df, df.withColumnRenamed("name", "known_name"), "loc").collect()}
    want = {(a, b): r for a in known for b in known if (r := SequenceMatcher(None, a, b).ratio()) >= people.MATCH}
    assert got == want and len(want) > len(known)


def plain_master(rows):
    seen, out = {}, {}
    for raw, week in sorted(rows, key=lambda r: (r[1], r[0])):
        name = raw
        if name in seen:
            continue
        best = max(((SequenceMatcher(None, name, k).ratio(), k) for k in out), default=(0, None))
        seen[name] = best[1] if best[0] >= people.MATCH else name
        if seen[name] == name:
            out[name] = week
    return out, seen


def test_master_table_against_one_after_another(spark):
    rng = np.random.default_rng(4)
    rows = [(x, f"2024-01-{int(d):02}") for x in names(40, 9) for d in rng.integers(1, 29, 2)]
    first = {}
    for raw, week in rows:
        first[raw] = min(week, first.get(raw, week))
    persons, _ = plain_master(first.items())
    df = spark.createDataFrame([("L", *r) for r in rows], "loc string, raw string, week string")
    got = {r.normalized_name: r.first_seen for r in identity.master_table(df, "loc", "week").collect()}
    assert got == persons and len(persons) < len(first)


def test_resolving_odd_names(spark):
    master = spark.createDataFrame([("L", "id-1", "Vira Holm", "vira holm")], "place string, stylist_id string, canonical_name string, normalized_name string")
    rows = spark.createDataFrame([("L", "VIRA HOLM"), ("L", "Vira Holmm"), ("M", "Vira Holm"), ("L", None), ("L", ""), ("L", "Vira Holm")], "place string, raw string").withColumn("seen", F.lit("2024"))
    got = [(r.place, r.raw, r.how) for r in identity.resolve(rows, master, "place", "seen").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [("L", "VIRA HOLM", "exact"), ("L", "Vira Holmm", "fuzzy"), ("M", "Vira Holm", "new"), ("L", None, "new"), ("L", "", "new"), ("L", "Vira Holm", "exact")]))
    assert identity.resolve(rows.limit(0), master, "place", "seen").count() == 0
    assert identity.resolve(rows, master.limit(0), "place", "seen").where("how = 'new'").count() == 6


def test_token_rows(spark):
    text = "Ann\nLee 1 (5.0%) 2\n3 Total 9 9 9 | Bo 4 5"
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "only words"), (5, "1 2 3")], "f int, text string")
    got = {(r.f, r.name): [float(x) for x in r.numbers] for r in summaries.token_rows(docs, ["f"], F.col("text"), 3).collect()}
    assert got == {(1, "Ann Lee"): [1, 2, 3], (1, "Total"): [9, 9, 9]}


def test_headers_and_tables_of_odd_sheets(spark):
    cells = [(1, 0, 0, "x"), (1, 1, 0, " NAME "), (1, 1, 1, "Value"), (1, 1, 2, "value"), (1, 2, 0, "a"), (1, 2, 1, "5"), (1, 2, 2, "6"), (1, 3, 0, " "), (1, 4, 0, "Totals"), (1, 5, 0, "b"), (2, 0, 0, "none")]
    df = spark.createDataFrame(cells, "s int, r int, c int, v string")
    heads = grids.header_map(df, ["s"], {"name": "name", "value": "value"}, first="name")
    assert sorted((r.field, r.c) for r in heads.collect()) == [("name", 0), ("value", 1)]
    assert [(r.name, r.value, r.is_total) for r in grids.read_table(df, ["s"], heads, ["name", "value"], "total").orderBy("r").collect()] == [("a", "5", False), ("Totals", None, True)]


def test_header_errors(spark):
    df = spark.createDataFrame([(["A", " b "],), (["a"],), (["x", "b"],), (None,)], "h array<string>")
    got = [r[0] for r in df.select(verify.header_errors(F.col("h"), F.array(F.lit("a"), F.lit("B")))).collect()]
    assert got == [[], [1], [0], [0, 1]]


def test_a_refused_version_is_never_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    one, two = spark.range(3), spark.range(5)
    assert stores.read_current(spark, path) is None
    stores.safe_overwrite(spark, path, one, "a")
    with pytest.raises(ValueError):
        stores.safe_overwrite(spark, path, two, "b", lambda d: f"{d.count()} rows")
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        stores.safe_overwrite(spark, path, broken, "c")
    assert stores.read_current(spark, path).count() == 3
    log = {r.caller: (r.status, r.n_rows, r.error) for r in spark.read.parquet(f"{path}/audit").collect()}
    assert log["a"][:2] == ("ok", 3) and log["b"][:1] == ("failed",) and log["b"][2] == "5 rows" and log["c"][0] == "failed"
    hashes = [stores.safe_overwrite(spark, path, d, "d") for d in (two.repartition(3), two.coalesce(1))]
    sha = {r.version: r.batch_sha256 for r in spark.read.parquet(f"{path}/audit").collect()}
    assert sha[hashes[0]] == sha[hashes[1]] and stores.read_current(spark, path).count() == 5


def test_a_failed_append_adds_nothing_and_can_be_run_again(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/ledger"
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    kept = ledger.existing_rows
    monkeypatch.setattr(ledger, "existing_rows", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ledger.append_ledger(spark, path, rows, ["k"], "v")
    monkeypatch.setattr(ledger, "existing_rows", kept)
    assert ledger.existing_rows(spark, path) is None and not list(tmp_path.glob("ledger__staged/*"))
    assert ledger.append_ledger(spark, path, rows, ["k"], "v") == {"received": 3, "repeated": 1, "appended": 2, "stored": 0}
    assert ledger.append_ledger(spark, path, rows, ["k"], "v") == {"received": 3, "repeated": 1, "appended": 0, "stored": 2}


def test_a_gate_keeps_a_batch_back(spark, tmp_path):
    path = f"{tmp_path}/g"
    assert stores.write_if_clean(spark, path, spark.range(2), spark.range(0), "a") and not stores.write_if_clean(spark, path, spark.range(9), spark.range(1), "b")
    assert stores.read_current(spark, path).count() == 2


def test_a_person_with_many_rows_is_read_in_order(spark, tmp_path):
    """More rows than an Arrow batch, out of order: one change of place is one move."""
    start = dt.datetime(2024, 1, 1)
    n = 12_000
    rows = spark.range(n).select(F.lit(1).alias("who"), F.when(F.col("id") < n // 2, "A").otherwise("B").alias("place"), (F.lit(start) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("ts"), F.hash("id").alias("h"))
    rows.orderBy("h").drop("h").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("who int, place string, ts timestamp").parquet(f"{tmp_path}/in")
    out = ingest.grace_period(stream, "who", "place", "ts")
    out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert [(r.from_place, r.to_place) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("A", "B")]
