"""Unit vectors and invariants of the operators."""

import datetime as dt
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import calendar, kpi, parsing
from tallyloom.operators import cumulative, enrich, history, ledger, people, report, triage, trust
from tallyloom.plans import weekly
from tallyloom.sources import facts

FOLDER = "/root/testdata/sf0.001"
D = dt.date


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def texts(spark, *rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")


def parsed(spark, f, *rows):
    return [r[0] for r in texts(spark, *rows).orderBy("i").select(f(F.col("t"))).collect()]


def snapshots(spark):
    rows = [("A", "2026-04", D(2026, 4, 5), 280, 16000.0, 2000.0, 280.0, 40, 720.0, 5300.0, 50, 900.0), ("A", "2026-04", D(2026, 4, 12), 562, 32132.5, 4225.0, 574.0, 80, 1440.0, 10866.0, 100, 1800.0)]
    return spark.createDataFrame(rows, "loc_name string, year_month string, week_ending date, guests int, service double, product double, prod_hours double, wax_count int, wax double, color double, treat_count int, treat double")


def test_weekly_difference(spark):
    row = kpi.with_ratios(cumulative.weekly(snapshots(spark), ["loc_name"])).where(F.col("week_ending") == D(2026, 4, 12)).first()
    assert (row.guests, row.service, row.product, row.prod_hours, row.wax_count, row.color) == (282, 16132.5, 2225.0, 294.0, 40, 5566.0)
    assert row.total_sales == 18357.5 and row.product_pct == 2225 / 18357.5 and row.ppg == 2225 / 282 and row.pph == 16132.5 / 294
    assert row.avg_ticket == 18357.5 / 282 and row.wax_pct == 40 / 282 and row.color_pct == 5566 / 16132.5 and row.treat_pct == 50 / 282


def test_first_week_and_refund(spark):
    s = snapshots(spark).withColumn("product", F.when(F.col("week_ending") == D(2026, 4, 12), 1900.0).otherwise(F.col("product")))
    assert values(cumulative.weekly(s, ["loc_name"]).orderBy("week_ending"), "guests", "product") == [(280, 2000.0), (282, -100.0)]


@pytest.mark.parametrize("mode, want", [(kpi.ZERO, 0.0), (kpi.NULL, None)])
def test_zero_denominator(spark, mode, want):
    df = snapshots(spark).withColumns({c: F.lit(0) for c in ("guests", "service", "product", "prod_hours")})
    assert set(values(kpi.with_ratios(df, empty=mode), "ppg", "pph", "avg_ticket", "product_pct")) == {(want,) * 4}


def test_prior_is_strictly_before(spark):
    got = cumulative.latest_prior(snapshots(spark), ["loc_name"], F.lit(D(2026, 4, 12)), ["guests"])
    assert values(got, "week_ending", "guests") == [(D(2026, 4, 5), 280)]


def test_weeks_add_up(spark):
    weeks = facts.location_weeks(spark, FOLDER)
    back = cumulative.weekly(cumulative.month_to_date(weeks, ["loc_name"]), ["loc_name"])
    keys = ["loc_name", "week_ending", "guests", "service", "product"]
    assert weeks.select(keys).exceptAll(back.select(keys)).count() == 0


def test_week_is_cut_at_month_end(spark):
    df = spark.createDataFrame([(D(2026, 4, 30),), (D(2026, 5, 1),), (D(2026, 5, 3),), (D(2026, 5, 4),)], "d date")
    assert [r[0] for r in df.orderBy("d").select(facts.week_ending(F.col("d"))).collect()] == [D(2026, 4, 30), D(2026, 5, 3), D(2026, 5, 3), D(2026, 5, 10)]


def test_ranks_are_permutations(spark):
    rows = enrich.ranks(kpi.with_ratios(facts.location_weeks(spark, FOLDER)), ["pph"], ["week_ending"], "loc_name")
    bad = rows.groupBy("week_ending").agg(F.count("*").alias("n"), F.max("rank_pph").alias("m"), F.count_distinct("rank_pph").alias("d")).where("n <> m OR n <> d")
    assert bad.count() == 0


def test_nearest_rank(spark):
    assert spark.range(1, 21).agg(enrich.nearest_rank("id", 85)).first()[0] == 18
    assert spark.range(1, 2).agg(enrich.nearest_rank("id", 85)).first()[0] == 1
    assert spark.range(0).agg(enrich.nearest_rank("id", 85)).first()[0] is None
    rows = spark.range(1, 41).select((F.col("id") % 3).alias("g"), "id").unionByName(spark.createDataFrame([(0, None), (5, 7)], "g long, id long"))
    want = {r.g: r.v for r in rows.groupBy("g").agg(enrich.nearest_rank("id", 85).alias("v")).collect()}
    assert {r.g: r.id for r in enrich.at_rank(rows, ["g"], "id", 85).collect()} == want and len(want) == 4


def test_z_flags_of_one_and_of_equal_values(spark):
    df = spark.createDataFrame([("w", "a", 5.0), ("v", "a", 3.0), ("v", "b", 3.0), ("v", "c", 0.0)], "w string, n string, x double")
    got = {(r.w, r.n): (r.z, r.flag) for r in enrich.z_flags(df, "x", ["w"]).collect()}
    assert got == {("w", "a"): (0.0, "solid"), ("v", "a"): (0.0, "solid"), ("v", "b"): (0.0, "solid"), ("v", "c"): (None, "solid")}


def test_monthly_trend_takes_the_largest(spark):
    rows = [("L", "2026-03", 7000.0), ("L", "2026-03", 8000.0), ("L", "2026-03", 28500.0), ("L", "2026-04", 18000.0), ("L", "2026-04", 18500.0), ("L", "2026-04", 17000.0), ("L", "2026-05", 0.0)]
    got = history.monthly_trend(spark.createDataFrame(rows, "loc_name string, year_month string, s double"), ["loc_name"], "s").orderBy("year_month")
    assert values(got, "year_month", "label", "s") == [("2026-03", "Mar 2026", 28500.0), ("2026-04", "Apr 2026", 18500.0)]


def test_rosters_and_padding(spark):
    now, before = spark.createDataFrame([("a", 3)], "n string, now int"), spark.createDataFrame([("a", 1), ("b", 2)], "n string, before int")
    assert sorted(values(history.rosters(now, before, ["n"]), "n", "now", "before", "only_before")) == [("a", 3, 1, False), ("b", 0, 2, True)]
    assert spark.range(1).select(history.pad_left(F.array(F.lit(1.0), F.lit(2.0)), 4)).first()[0] == [0.0, 0.0, 1.0, 2.0]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=st.dates(D(1990, 1, 1), D(2030, 1, 1)), n=st.integers(0, 400))
def test_working_days(spark, first, n):
    last = first + dt.timedelta(days=n)
    want = sum((first + dt.timedelta(days=i)).weekday() != 6 for i in range(n + 1))
    assert spark.range(1).select(calendar.working_days(F.lit(first), F.lit(last))).first()[0] == want


def test_projection_and_override(spark):
    df = spark.createDataFrame([("2026-05", D(2026, 5, 9), 800.0)], "year_month string, week_ending date, s double")
    assert values(calendar.projected(df, "s"), "days_elapsed", "days_in_month", "projection") == [(8, 26, 2600.0)]
    assert values(calendar.projected(df, "s", spark.createDataFrame([("2026-05", 25)], "year_month string, days long")), "projection") == [(2500.0,)]


def test_parsers(spark):
    assert [str(x) if x is not None else None for x in parsed(spark, parsing.money, "$1,234.56", "($80.00)", "-$80", "$-80", "", None, "x")] == ["1234.56", "-80.00", "-80.00", "-80.00", None, None, None]
    assert parsed(spark, parsing.hours, "150h 30m", "99h 45m", "45m", "3.5", "", None) == [150.5, 99.75, 0.75, 3.5, None, None]
    assert parsed(spark, parsing.day, "46166", "1.5", "2026-05-24", "5/24/2026", "24 May 2026", "", None, "13/13/2026") == [D(2026, 5, 24), D(1899, 12, 31), D(2026, 5, 24), D(2026, 5, 24), D(2026, 5, 24), None, None, None]
    assert parsed(spark, parsing.person, "Vira Holm Jr", "V. Holm", "Vira (PT)", "Vira  Holm Mgr", "Vira Holm III Lead", "Asst. Vira", None) == ["vira holm", "v holm", "vira", "vira holm", "vira holm", "vira", None]
    assert parsed(spark, parsing.header, "  Total \t SALES ", None) == ["total sales", None]
    assert parsed(spark, parsing.number, "12.5%", "$1,000", "n/a", None) == [12.5, 1000.0, 0.0, 0.0]
    assert parsed(spark, lambda c: parsing.dialect(c), "x EMPLOYEE SALE DETAILS", "Provider Tracker", "provider tracker center name", "y", None) == ["zenoti", "salon_ultimate", None, None, None]
    assert [r and tuple(r) for r in parsed(spark, parsing.date_range, "From: 5/1/2026 To: 5/9/2026", "05/17/2026 - 05/23/2026", "5/9/2026 - 5/1/2026", "")] == [(D(2026, 5, 1), D(2026, 5, 9)), (D(2026, 5, 17), D(2026, 5, 23)), None, None]


def test_sheet_rows_and_grid(spark):
    sheet = "Center: Main\nEMPLOYEE SALE DETAILS\nAnn Lee $1,000.00 $100.00 20 15 $200.00\nBo 500 50 10 8 100\nA B C D 1 2 3 4\nTotal 1 2\n"
    got = parsing.person_rows(spark.createDataFrame([(1, sheet)], "f int, text string"), "text").orderBy("place")
    assert [(r.name, [float(x) for x in r.numbers]) for r in got.collect()] == [("Ann Lee", [1000.0, 100.0, 20.0, 15.0, 200.0]), ("Bo", [500.0, 50.0, 10.0, 8.0, 100.0])]
    cells = spark.createDataFrame([(1, 3, "Total Service", "9"), (1, 2, " Total Service", "4321.05"), (1, 1, "Total", "1")], "f int, row int, label string, value string")
    assert values(parsing.grid_value(cells, ["f"], "Total Service"), "value") == [("4321.05",)]


def test_ledger_is_idempotent(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    rows = spark.createDataFrame([("a", 1, 10), ("a", 1, 11), ("b", 1, 12)], "k string, p int, v int")
    assert ledger.append_ledger(spark, path, rows, ["k", "p"], "v")["appended"] == 2
    assert ledger.append_ledger(spark, path, rows, ["k", "p"], "v")["appended"] == 0
    assert sorted(values(spark.read.parquet(path), "k", "v")) == [("a", 10), ("b", 12)]


def test_upsert_patch_and_roster(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    assert sorted(values(ledger.upsert(base, new, ["k"]), "k", "v")) == [("a", 1), ("b", 9), ("c", 3)]
    assert sorted(values(ledger.patch(base, new, ["k"], ["v"]), "k", "v")) == [("a", 1), ("b", 9)]
    roster = spark.createDataFrame([("a", 2), ("b", 1), ("z", 3)], "k string, ordinal int")
    assert values(ledger.roster_merge(base, new, roster, "k", ["v"]).orderBy("ordinal"), "k", "v", "origin") == [("b", 9, "fresh"), ("a", 1, "kept"), ("z", None, "blank")]


def test_distribution_adds_up(spark):
    p = spark.createDataFrame([("L", "a", 30.0), ("L", "b", 70.0), ("M", "c", 0.0)], "loc string, n string, w double")
    got = ledger.distribute(p, spark.createDataFrame([("L", 50.0), ("M", 8.0)], "loc string, x double"), ["loc"], "w", ["x"]).orderBy("n")
    assert values(got, "n", "alloc_x") == [("a", 15.0), ("b", 35.0), ("c", 0.0)]


@pytest.mark.parametrize("share, want", [(0.0, "PROCEED"), (0.1, "WARN"), (0.2, "CONFIRM"), (0.5, "BLOCK")])
def test_overlap(spark, share, want):
    assert spark.range(1).select(ledger.overlap_action(F.lit(share))).first()[0] == want


def test_scores_stay_in_range(spark):
    s = trust.confidence_scores(spark, FOLDER)
    assert s.where("score < 0 OR score > 100").count() == 0
    checks = spark.createDataFrame([("a", "x", "fail", 50), ("a", "y", "warn", 60), ("b", "x", "pass", 0)], "k string, name string, status string, severity long")
    assert sorted(values(trust.scores(checks, ["k"]), "k", "score", "tier")) == [("a", 0, "low"), ("b", 100, "high")]


@pytest.mark.parametrize("a, b, want", [("100.00", "100.01", "ok"), ("100.00", "100.90", "soft"), ("100.00", "110.00", "hard")])
def test_gap_tiers(spark, a, b, want):
    d = lambda x: F.lit(x).cast("decimal(18,2)")
    assert spark.range(1).select(trust.gap_tier(d(a), d(b))).first()[0] == want


def test_near_periods_matches_all_pairs(spark):
    days = [D(2026, 1, 1) + dt.timedelta(days=i * 2) for i in range(20)]
    a = spark.createDataFrame([("k", d) for d in days], "k string, a date")
    b = spark.createDataFrame([("k", d + dt.timedelta(days=1)) for d in days], "k string, b date")
    got = values(trust.near_periods(a, b, "k", "a", "b", 3), "a", "b")
    assert sorted(got) == sorted((x, y + dt.timedelta(days=1)) for x in days for y in days if abs((x - y).days - 1) <= 3)


@pytest.mark.parametrize("a, b, want", [(15, 16, 15 / 16), (15, 4, 0.3), (0, 4, 0.5), (None, 4, 0.5), (7, 7, 1.0)])
def test_closeness(spark, a, b, want):
    assert spark.range(1).select(people.closeness(F.lit(a).cast("int"), F.lit(b))).first()[0] == want


def test_flow_nets_to_zero(spark):
    assert people.talent_flow(spark, FOLDER).agg(F.sum("net")).first()[0] == 0


def test_fuzzy_match_prefers_exact_and_best(spark):
    known = spark.createDataFrame([("L", "vira holm"), ("L", "vira hol"), ("M", "vira hoom")], "loc string, name string")
    new = spark.createDataFrame([("L", "vira holm"), ("L", "vira holmm"), ("L", "zoe"), ("M", "vira holm")], "loc string, name string")
    got = {(r["loc"], r["name"]): r["known_name"] for r in people.best_match(new, known, "loc").collect()}
    assert got == {("L", "vira holm"): "vira holm", ("L", "vira holmm"): "vira holm", ("M", "vira holm"): "vira hoom"}


def test_impact_window(spark):
    day = lambda n: D(2026, 1, 1) + dt.timedelta(days=n)
    rows = [(i, 1, day(i * 7), "A", 140, 15) for i in range(4)] + [(10 + i, 1, day(28 + i * 7), "B", 160, 18) for i in range(4)]
    v = spark.createDataFrame(rows, "visit int, person int, day date, loc_name string, revenue int, n_lines int")
    r = people.before_and_after(v, 28).first()
    assert (r.from_loc, r.to_loc, r.pre_revenue, r.post_revenue, r.pre_lines, r.post_lines) == ("A", "B", 140.0, 160.0, 15.0, 18.0)


def test_first_rule_wins(spark):
    df = spark.createDataFrame([("a@x", "hi", True, False), ("b@bad", "hi", False, False), ("c@x", "SALE now", False, True), ("c@x", "sale", False, False), ("noreply@x", None, False, False), ("d@x", "hi", False, False)], "sender string, subject string, has_unsubscribe boolean, has_list_id boolean")
    rules = triage.noise_rules(("a@x",), (), ("bad",), "sale", "^noreply")
    assert [r[0] for r in df.select(triage.first_rule(rules)).collect()] == ["real", "blocked domain", "mailing list", "subject", "automated sender", "real"]


def test_totals_row(spark):
    rows = kpi.with_ratios(snapshots(spark).withColumn("loc_name", F.date_format("week_ending", "d")))
    got = report.with_totals(rows, ["year_month"], "loc_name", facts.ADDITIVE).where("loc_name = 'TOTALS'").first()
    assert got.n_rows == 2 and got.guests == 842 and got.avg_ticket == 54357.5 / 842


def test_weekly_run_twice(spark, tmp_path):
    target = f"{tmp_path}/{uuid.uuid4().hex}"
    first, again = weekly.run(spark, FOLDER, target), weekly.run(spark, FOLDER, target)
    assert first["appended"] > 0 and again["appended"] == 0
    assert spark.read.parquet(f"{target}/weeks").count() == first["appended"]


def test_report_files(spark, tmp_path):
    from tallyloom.sources.tables import json_lines, report_files

    (tmp_path / "b/2026-05-24").mkdir(parents=True)
    (tmp_path / "b/2026-05-24/x.html").write_text("<p>hé</p>")
    (tmp_path / "b/2026-05-24/x.bin").write_text("no")
    r = report_files(spark, str(tmp_path)).first()
    assert (r.bucket, r.week_ending, r.text) == ("b", D(2026, 5, 24), "<p>hé</p>")
    (tmp_path / "e.jsonl").write_text('{"a": 1}\nbad\n{"a": 2}\n')
    assert values(json_lines(spark, str(tmp_path / "e.jsonl"), "a int").where("a IS NOT NULL").orderBy("a"), "a") == [(1,), (2,)]


def test_transfer_pairs_hold_every_destination(spark):
    from tallyloom.queries import QUERIES
    from tallyloom.sources import facts

    folder = "/root/testdata/sf0.001"
    pairs = QUERIES["transfer_pairs"](spark, folder).collect()
    total, last = {}, {}
    for v in sorted(facts.visits(spark, folder).collect(), key=lambda v: (v.day, v.visit)):
        if last.get(v.person, v.loc_name) != v.loc_name:
            total[last[v.person]] = total.get(last[v.person], 0) + 1
        last[v.person] = v.loc_name
    assert {f: sum(r.n for r in pairs if r.from_loc == f) for f in total} == total and len({r.to_loc for r in pairs}) > 4


def test_paths_go_beyond_three_locations(spark):
    from tallyloom.operators import people

    rows = [(p, d, d, loc) for p, locs in ((1, "ABBCDE"), (2, "ABCDE"), (3, "ABCDA")) for d, loc in enumerate(locs)]
    got = people.paths(spark.createDataFrame(rows, "person long, visit long, day int, loc_name string")).collect()
    assert {r.person: r.path for r in got} == {1: "A > B > C > D > E", 2: "A > B > C > D > E", 3: "A > B > C > D > A"}
