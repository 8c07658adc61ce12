"""Batches over a growing folder, running sums over parts, and sheets printed over several pages."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import grids, manifest, ranges, stores, summaries


def parse(files):
    """A file of numbers; letters are an error."""
    bad = F.col("text").rlike("[a-z]")
    rows = files.select("path", F.when(bad, "letters").alias("error"), F.explode_outer(F.when(~bad, F.filter(F.split("text", r"\s+"), lambda x: x != ""))).alias("n"))
    return rows.select("path", "error", F.when(F.col("n").isNotNull(), F.struct(F.col("n").cast("int").alias("n"))).alias("row"))


@pytest.fixture
def batch(spark, tmp_path, monkeypatch):
    read, kept = [], manifest.contents

    def contents(spark, paths):
        df = kept(spark, paths)
        read.append(sorted(f.rsplit("/", 1)[1] for f in df.inputFiles()))
        return df

    monkeypatch.setattr(manifest, "contents", contents)
    folder = tmp_path / "in"
    folder.mkdir()

    def run():
        read.clear()
        said = manifest.run(spark, str(folder), str(tmp_path / "state"), str(tmp_path / "sink"), parse)
        return {k: v for k, v in said.items() if v}, [x for part in read for x in part]

    def rows():
        return sorted(r.n for r in manifest.rows_in_force(spark, str(tmp_path / "state"), str(tmp_path / "sink")).collect())

    return folder, run, rows


def test_runs_over_a_growing_folder(batch):
    """Only new, changed and failed files are read; a bad one is given up in the end."""
    folder, run, rows = batch
    (folder / "a.txt").write_text("1 2\n")
    (folder / "b.txt").write_text("oops")
    (folder / "c.txt").write_text(" ")  # no row
    assert run() == ({"run": 1, "new": 3, "done": 2, "failed": 1}, ["a.txt", "b.txt", "c.txt"]) and rows() == [1, 2]
    (folder / "d.txt").write_text("3")
    (folder / "e.txt").write_text("1 2\n")  # a's content
    assert run() == ({"run": 2, "new": 2, "again": 1, "done": 1, "failed": 1, "copy": 1}, ["b.txt", "d.txt", "e.txt"]) and rows() == [1, 2, 3]
    (folder / "d.txt").write_text("30 31")
    assert run() == ({"run": 3, "changed": 1, "again": 1, "done": 1, "given_up": 1}, ["b.txt", "d.txt"]) and rows() == [1, 2, 30, 31]
    assert run() == ({"run": 3}, []) and rows() == [1, 2, 30, 31]
    (folder / "b.txt").write_text("7")  # mended after all
    (folder / "a.txt").write_text("8 88")  # of which e was a copy
    assert run() == ({"run": 4, "changed": 2, "again": 1, "done": 3}, ["a.txt", "b.txt", "e.txt"]) and rows() == [1, 2, 7, 8, 30, 31, 88]


def test_a_run_that_dies_is_run_again(spark, batch, monkeypatch, tmp_path):
    folder, run, rows = batch
    (folder / "a.txt").write_text("1 2")
    kept = manifest.commit
    monkeypatch.setattr(manifest, "commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run()
    assert stores.current_number(spark, str(tmp_path / "state")) == 0
    monkeypatch.setattr(manifest, "commit", kept)
    assert run()[0] == {"run": 1, "new": 1, "done": 1} and rows() == [1, 2]
    (folder / "b.txt").write_text("3")
    monkeypatch.setattr(manifest, "commit", lambda *_: False)  # another run was first
    with pytest.raises(stores.Conflict):
        run()
    monkeypatch.setattr(manifest, "commit", kept)
    assert rows() == [1, 2] and run()[0] == {"run": 2, "new": 1, "done": 1} and rows() == [1, 2, 3]


def test_files_beyond_one_job(batch, monkeypatch):
    folder, run, rows = batch
    monkeypatch.setattr(manifest, "AT_ONCE", 2)
    for i in range(5):
        (folder / f"{i}.txt").write_text(str(i % 4))
    assert run()[0] == {"run": 1, "new": 5, "done": 4, "copy": 1} and rows() == [0, 1, 2, 3]


@pytest.mark.parametrize("parts", [1, 7])
def test_running_sums_and_places(spark, parts):
    """One key with most rows, a null key, null values, and a key that has only those."""
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 8 + ["b", None]), rng.randrange(50), i, rng.choice([None, *range(9)])) for i in range(3000)] + [("none", 1, 9000 + i, None) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, at int, id int, v int")
    got = ranges.running(df, ["k"], [F.col("at").asc(), F.col("id").desc()], {"so_far": "v"}, parts=parts).collect()
    want, seen = {}, {}
    for k, at, i, v in sorted(rows, key=lambda r: (r[1], -r[2])):
        n, s = seen.get(k, (0, None))
        seen[k] = (n + 1, s if v is None else (s or 0) + v)
        want[i] = (k, *seen[k])
    assert {r.id: (r.k, r.place, r.so_far) for r in got} == want and len(got) == len(rows)
    places = {r.id: r.place for r in ranges.global_rank(df, [F.col("id").desc()]).collect()}
    assert places == {i: n for n, i in enumerate(sorted((r[2] for r in rows), reverse=True), 1)}
    assert ranges.running(df.limit(0), ["k"], [F.col("id")], {"so_far": "v"}).count() == 0


NAMES = {"name": "name", "sales": "sales", "hours": "hours"}


def stitched(spark, cells):
    df = spark.createDataFrame(cells, "s int, page int, r int, c int, v string")
    out = {}
    for x in grids.stitched(df, ["s"], NAMES, "name").collect():
        out.setdefault((x.s, x.r), {})[x.c] = x.v
    return out


def test_a_table_over_three_pages(spark):
    """The second page has no header and lies two columns to the right, the third repeats it with columns in other places."""
    page = lambda n, rows, left=0: [(1, n, r, left + c, v) for r, row in rows for c, v in enumerate(row) if v is not None]
    cells = page(1, [(0, ["Store", "x"]), (3, ["Name", "Sales", "Hours", "Note"]), (4, ["Ann", "1", "2", "n"]), (5, ["Bo", None, "4"])])
    cells += page(2, [(0, ["Cy", "5", "6", "n"]), (2, ["Di", "7", " "])], 2)
    cells += page(4, [(0, ["more"]), (1, ["Name", "Hours", "Sales"]), (2, ["Ed", "9", "8"])], 1)
    cells += [(2, 1, 0, 0, "no header"), (3, 1, 0, 0, " "), (4, 1, 0, 0, "Name"), (4, 1, 0, 1, "Sales")]
    header = {0: "name", 1: "sales", 2: "hours"}
    want = {(1, 0): header, (1, 1): {0: "Ann", 1: "1", 2: "2"}, (1, 2): {0: "Bo", 2: "4"}, (1, 3): {0: "Cy", 1: "5", 2: "6"}, (1, 4): {0: "Di", 1: "7"}, (1, 5): {0: "Ed", 1: "8", 2: "9"}, (4, 0): header}
    assert stitched(spark, cells) == want
    whole = spark.createDataFrame([(1, r, c, v) for (s, r), row in want.items() if s == 1 for c, v in row.items()], "s int, r int, c int, v string")
    read = grids.read_table(whole, ["s"], grids.header_map(whole, ["s"], NAMES, first="name"), list(NAMES), "total").orderBy("r")
    assert [(r.name, r.sales, r.hours) for r in read.collect()] == [("Ann", "1", "2"), ("Bo", None, "4"), ("Cy", "5", "6"), ("Di", "7", None), ("Ed", "8", "9")]
    assert grids.stitched(spark.createDataFrame([], "s int, page int, r int, c int, v string"), ["s"], NAMES, "name").count() == 0


def test_all_is_no_person(spark):
    df = spark.createDataFrame([("All",), (" ALL ",), ("Allan Poe",), ("house  sale",), ("The Unknown",), ("Kim mgr",), (None,)], "n string")
    assert [r[0] for r in df.select(summaries.is_artifact(F.col("n"))).collect()] == [True, True, False, True, True, True, None]


def test_a_dashboard_with_gaps(spark):
    sheets = {
        1: [["Store name:", "FS - L"], ["Report period:", "05/17/2026 - 05/23/2026"], ["total service", "$10.00"], ["Total Retail", "(2.00)"], ["TOTAL Guests", "1,204"], ["Production Hours", "427h 27m"], ["Service Categories", "Qty", "a", "b", "Sales"],
            ["Wax", "2", "", "", "4.00"], ["waxing", "", "", "", "1"], ["Other", "1", "", "", "5.01"], [None, "1", "", "", "7"], ["Color", "1", "", "", "9"]],
        2: [["Total Service", "5"], ["Tips", "n/a"], ["Service Categories"], ["TOTALS", "1", "", "", "4"]], 3: [["nothing", "1"]],
    }
    cells = [(s, r, c, v) for s, rows in sheets.items() for r, row in enumerate(rows) for c, v in enumerate(row) if v is not None]
    got = {r.s: r.asDict() for r in grids.dashboard_rows(spark.createDataFrame(cells, "s int, r int, c int, v string"), ["s"]).collect()}
    assert set(got) == {1, 2}
    plain = {k: float(v) if k not in ("store_name", "flags", "reconciled", "period_start", "period_end") and v is not None else v for k, v in got[1].items()}
    assert {k: str(v) for k, v in plain.items() if v is not None and k != "s"} == {
        "store_name": "FS - L", "period_start": "2026-05-17", "period_end": "2026-05-23", "service": "10.0", "product": "-2.0", "guests": "1204.0", "hours": "427.45", "wax_net": "5.0", "wax_count": "2.0", "categories_net": "10.01",
        "total_sales": "8.0", "gap": "-0.01", "reconciled": "True", "flags": "",
    }
    assert (got[2]["tips"], got[2]["flags"], got[2]["reconciled"], got[2]["categories_net"]) == (None, "totals_row", False, None)
