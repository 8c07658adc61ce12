"""Labels as data, report folders as a data source, and where people work, against plain loops."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import labels, people, transfers
from tallyloom.sources.reports import ReportFolder, reports

D = dt.date


def read(spark, rows, table=None):
    docs = spark.createDataFrame(rows, "id int, d string, t string")
    got = labels.labelled(docs, ["id"], "d", "t", labels.dialects(spark) if table is None else table)
    return {(r.id, r.field or r.label): r.value for r in got.collect()}


def test_both_systems_labels(spark):
    z = "Service  sales 1,012 35,000.50 34,900.25 (71.4)\nProduct sales\n7\n100.00\n90.00 (2)\nRebooked 12 (40.5)\nTax 9.5\nSales Tax 3\nTIPS COLLECTED\nCash 5.00\nTotal 77.25\nEMPLOYEE SALE\nTotal 1.00"
    u = "Total Service: $1,200.10 Avg Tips $3 Tips ($4.50)\nMale New Request 8 New Request 9\nProduction Hours 287h\nCards 4 Walk outs\n18m\nNon-Production Hours 30h 1m\nTotal Hours 12.5\nRebook % 12.5 %\nTOTAL Guests -3\nPPH none"
    got = read(spark, [(1, "zenoti", z), (2, "salon_ultimate", u), (3, "zenoti", None), (4, "zenoti", ""), (5, None, "Tips 3"), (6, "salon_ultimate", "Production Hours 5h " + "x " * 250 + "18m")])
    want = {(1, "service_count"): 1012, (1, "service_gross"): 35000.5, (1, "service_net"): 34900.25, (1, "product_count"): 7, (1, "product_gross"): 100, (1, "product_net"): 90, (1, "rebooked_count"): 12, (1, "rebooked_pct"): 40.5, (1, "tax"): 9.5, (1, "Sales"): None,
            (1, "Cash"): 5, (1, "tips_total"): 77.25, (1, "Total"): 1, (2, "total_service"): 1200.1, (2, "tips"): 4.5, (2, "new_request"): 9, (2, "production_hours"): 287.3, (2, "Cards"): 4, (2, "non_production_hours"): 30 + 1 / 60, (2, "total_hours"): 12.5,
            (2, "rebook_pct"): 12.5, (2, "total_guests_pdf"): -3, (5, "Tips"): 3, (6, "production_hours"): 5}
    del want[1, "Sales"]  # "Tax" is a label wherever it stands, as for the first one
    assert got == pytest.approx(want)


def test_a_label_is_added_without_code(spark):
    rows = [(1, "zenoti", "Gift wrap 3\nGift wrap paper 4\nLoyalty points 12 34")]
    assert read(spark, rows) == {(1, "Gift wrap"): 3, (1, "Gift wrap paper"): 4, (1, "Loyalty points"): 12} | {(1, "Loyalty points"): 12}
    more = labels.dialects(spark).unionByName(spark.createDataFrame([("zenoti", None, "Gift wrap", "wraps", 1, "count"), ("zenoti", None, "Loyalty points", "points", 2, "count")], labels.LABELS))
    assert read(spark, rows, more) == {(1, "wraps"): 3, (1, "paper"): 4, (1, "points"): 34}
    assert labels.labelled(spark.createDataFrame([], "id int, d string, t string"), ["id"], "d", "t", more).count() == 0


def test_too_many_labels(spark, monkeypatch):
    monkeypatch.setattr(labels, "MOST", 3)
    with pytest.raises(ValueError, match="more than 3 labels"):
        read(spark, [(1, "zenoti", "x")])


# --- report folders


@pytest.fixture
def folder(tmp_path):
    """Files of three weeks; those of the last one cannot be opened."""
    for week in ("2024-01-07", "2024-01-14", "2024-01-21"):
        for place in ("L", "M"):
            at = tmp_path / "in/zenoti" / week / f"place={place}"
            at.mkdir(parents=True)
            if week == "2024-01-21":
                os.symlink("/proc/self/mem", at / "a.txt")  # whose first bytes are not there
            else:
                (at / "a.txt").write_text(f"{place} é {week}")
    (tmp_path / "in/zenoti/2024-01-07/place=L/_SUCCESS").write_text("")
    (tmp_path / "in/odd.txt").write_text("top")
    return tmp_path / "in"


def test_a_filter_opens_only_its_files(spark, folder):
    df = reports(spark, str(folder))
    with pytest.raises(Exception, match="Input/output error"):
        df.collect()
    got = df.where("week_ending < DATE '2024-01-21' AND location = 'M'").collect()
    assert sorted((r.bucket, r.week_ending, r.location, r.text) for r in got) == [("zenoti", D(2024, 1, d), "M", f"M é 2024-01-{d:02}") for d in (7, 14)]
    assert df.where(F.col("week_ending").isin(D(2024, 1, 7)) & (F.length("text") > 0)).count() == 2
    assert df.where("week_ending = DATE '2024-01-21' AND location = 'N'").count() == 0
    assert [(r.bucket, r.week_ending, r.text) for r in df.where(f"path = '{folder}/odd.txt'").collect()] == [(None, None, "top")]


def test_a_stream_takes_each_file_once(spark, folder, tmp_path):
    for p in folder.glob("zenoti/2024-01-21/*/a.txt"):
        p.unlink()
    spark.dataSource.register(ReportFolder)

    def take():
        stream = spark.readStream.format("report_folder").load(str(folder))
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").start().processAllAvailable()
        for q in spark.streams.active:
            q.stop()
        return sorted(r.text for r in spark.read.parquet(f"{tmp_path}/out").collect())

    first = take()
    assert len(first) == 5
    at = folder / "zenoti/2024-01-28/place=L"
    at.mkdir(parents=True)
    (at / "b.txt").write_text("new")
    assert take() == sorted([*first, "new"])


# --- where people work


def test_location_pattern(spark):
    rng = random.Random(6)
    weeks = [D(2024, 1, 7) + dt.timedelta(7 * i) for i in range(14)]
    rows = [(rng.randrange(5), rng.choice(weeks), rng.choice("AAABC"), rng.randrange(1, 4)) for _ in range(160)]
    got = {(r.person, r.week): r for r in transfers.location_pattern(spark.createDataFrame(rows, "person int, week date, loc_name string, n int")).collect()}
    assert set(got) == {(p, w) for p, w, _, _ in rows}
    several = 0
    for (p, w), r in got.items():
        back = [x for x in rows if x[0] == p and w - dt.timedelta(21) <= x[1] <= w]
        n = {loc: sum(x[3] for x in back if x[2] == loc) for loc in {x[2] for x in back}}
        usual = sorted(loc for loc in n if len({x[1] for x in back if x[2] == loc}) >= 2)
        first = min(n, key=lambda loc: (-n[loc], loc))
        assert r.primary_location == first and r.is_multi_location == (len(usual) >= 2)
        assert (r.secondary_locations or "").split(";") == ([x for x in usual if x != first] if len(usual) >= 2 else [""])
        assert r.split == ";".join(f"{loc}:{1000 * n[loc] // sum(n.values())}" for loc in sorted(n))
        several += r.is_multi_location
    assert 3 < several < len(got)


def test_impact_classes(spark):
    rows = [(0.1, 0.1), (0.2, 0.06), (0.05, -0.3), (0.0, 0.05), (-0.1, 0.0), (0.04, -0.1), (-0.09, 0.04), (None, None), (None, 0.2)]
    got = [r[0] for r in spark.createDataFrame(rows, "t double, g double").select(transfers.impact(F.col("t"), F.col("g"))).collect()]
    assert got == ["TALENT DEVELOPER", *["POSITIVE IMPACT"] * 3, "WARNING", "WARNING", "NEUTRAL", "NEUTRAL", "POSITIVE IMPACT"]


def test_shared_paths(spark):
    rows = [(p, i, D(2024, 1, 1 + i), loc) for p, path in enumerate(["AB", "AAB", "ABB", "AC", "ACC", "D", "D", "D"]) for i, loc in enumerate(path)]
    v = spark.createDataFrame(rows, "person int, visit int, day date, loc_name string")
    get = lambda *a: {r.path: r.n_people for r in people.shared_paths(v, *a).collect()}
    assert get() == {"A > B": 3} and get(2) == {"A > B": 3, "A > C": 2} and get(3, 1) == {"A > B": 3, "D": 3}
