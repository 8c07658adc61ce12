"""Rounds against one after another, orders in two times, versions under two writers, and streams that are shuffled, stopped and replayed."""

import datetime as dt
import random
from difflib import SequenceMatcher

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import orders, rounds, stores
from tallyloom.streaming import ingest

D = dt.date


def test_first_wins_against_one_after_another(spark):
    """Random graphs, and a chain in which every name waits for the one before it."""
    rng = random.Random(2)
    pairs = [("g", f"n{b:03}", f"n{a:03}") for a in range(60) for b in range(a + 1, 60) if rng.random() < 0.06]
    pairs += [("chain", f"n{i + 1:03}", f"n{i:03}") for i in range(9)] + [("other", "b", "a"), ("g", None, "n000"), ("g", "n005", None)]
    want = {}
    for g in ("g", "chain", "other"):
        of = {}
        for _, name, known in (p for p in pairs if p[0] == g and p[1] and p[2]):
            of.setdefault(name, set()).add(known)
            of.setdefault(known, set())
        for name in sorted(of):
            want[g, name] = not any(want[g, k] for k in of[name])
    got = rounds.first_wins(spark.createDataFrame(pairs, "g string, name string, known string"), ["g"], "known").collect()
    assert {(r.g, r.name): r.is_first for r in got} == want and len(got) == len(want)
    assert [want["chain", f"n{i:03}"] for i in range(4)] == [True, False, True, False]
    assert rounds.first_wins(spark.createDataFrame([], "g string, name string, known string"), ["g"], "known").count() == 0


def test_claims_against_choosing_in_order(spark):
    rng = random.Random(5)
    pairs = sorted({(f"p{rng.randrange(25):02}", f"o{rng.randrange(18):02}") for _ in range(150)})
    seq, made = {p: rng.randrange(9) for p, _ in pairs}, {o: rng.randrange(4) for _, o in pairs}
    free, want = set(made), {}
    for p in sorted(seq, key=lambda p: (seq[p], p)):
        may = sorted((o for q, o in pairs if q == p and o in free), key=lambda o: (made[o], o))
        if may:
            want[p] = may[0]
            free.remove(may[0])
    df = spark.createDataFrame([(p, o, seq[p], made[o]) for p, o in pairs] + [(None, "o00", 0, 0), ("p99", None, 0, 0)], "p string, o string, s int, m int")
    got = rounds.claims(df, "p", "o", F.col("s"), F.col("m")).collect()
    assert {r.p: r.o for r in got} == want and len(got) == len(want)


def plain_state(event, given, at):
    """(status, effective day) of an event as known on a day, by going through its orders."""
    if at < event["known"]:
        return None
    status, day = "DETECTED", event["day"]
    for o in sorted((o for o in given if o["event_id"] == event["event_id"]), key=lambda o: (max(o["given"], event["known"]), o["order_id"])):
        if max(o["given"], event["known"]) <= at:
            status = {"revert": "INVALID", "confirm": "CONFIRMED"}.get(o["kind"], status)
            day = o["effective_day"] if o["kind"] == "effective_date" and o["effective_day"] else day
    return status, day


def test_orders_in_two_times(spark):
    """Random orders, some of one moment, some given before their event was known: every reading of every day."""
    rng = random.Random(1)
    start = D(2024, 1, 1)
    day = lambda n: start + dt.timedelta(n)
    events, given = [], []
    for p in range(6):
        at = "A"
        for k in range(4):
            to = rng.choice([x for x in "ABCD" if x != at])
            n = 10 * k + rng.randrange(8)
            events.append({"event_id": f"{p}-{k}", "person": p, "from_loc": at, "to_loc": to, "day": day(n), "known": day(n + rng.randrange(4))})
            at = to
            for j in range(rng.randrange(5)):
                kind = rng.choice(["revert", "confirm", "effective_date", "effective_date", "advice"])
                given.append({"event_id": f"{p}-{k}", "order_id": f"{j}", "kind": kind, "effective_day": day(n + rng.randrange(-15, 9)) if kind == "effective_date" else None, "given": day(n + rng.randrange(-3, 20))})
    given += [{"event_id": "no such", "order_id": "x", "kind": "revert", "effective_day": None, "given": day(3)}, {"event_id": "0-0", "order_id": "y", "kind": "revert", "effective_day": None, "given": None}]
    e = spark.createDataFrame(events, "event_id string, person int, from_loc string, to_loc string, day date, known date")
    o = spark.createDataFrame(given, "event_id string, order_id string, kind string, effective_day date, given date")
    history = orders.versions(e, o).cache()
    real = [x for x in given if x["given"]]
    rows = history.collect()
    for x in events:
        mine = sorted((r for r in rows if r.event_id == x["event_id"]), key=lambda r: r.known_from)
        assert mine[0].known_from == x["known"] and mine[-1].known_to is None and all(a.known_to == b.known_from for a, b in zip(mine, mine[1:]))
        for n in range(-5, 70):
            now = [(r.status, r.effective_day) for r in mine if r.known_from <= day(n) and (r.known_to is None or r.known_to > day(n))]
            assert now == ([s] if (s := plain_state(x, real, day(n))) else []), (x, n)
    asked = [(p * 1000 + i, p, day(rng.randrange(-5, 60)), day(rng.randrange(-2, 70))) for p in range(7) for i in range(40)]
    got = {r.question: r.loc_name for r in orders.where_was(history, spark.createDataFrame(asked, "question int, person int, on_day date, as_of date")).collect()}
    for q, p, on, as_of in asked:
        known = [(x, plain_state(x, real, as_of)) for x in events if x["person"] == p]
        known = [(x, s) for x, s in known if s]
        valid = [(s[1], x["day"], x["event_id"], x["to_loc"]) for x, s in known if s[0] != "INVALID" and s[1] <= on]
        first = min(known, key=lambda x: (x[0]["day"], x[0]["event_id"]))[0]["from_loc"] if known else None
        assert got[q] == (max(valid)[3] if valid else first)
    known = orders.as_known(history, F.lit(day(30)))
    held = orders.stays(known).collect()
    assert held and all(r.valid_to is None or r.valid_to > r.valid_from for r in held)
    for p in range(6):
        mine = sorted((r for r in held if r.person == p), key=lambda r: r.valid_from)
        assert all(a.valid_to <= b.valid_from for a, b in zip(mine, mine[1:])) and sum(r.valid_to is None for r in mine) == (1 if mine else 0)


ORDER = "order_id string, loc_name string, name string, created int, status string, completed_at date"
PERSON = "person_id string, loc_name string, name string, seq int"


def test_an_order_is_taken_once(spark, tmp_path):
    path, at = str(tmp_path / "orders"), F.lit(D(2024, 1, 7))
    people = spark.createDataFrame([("a", "L", "Vira Holmm", 2), ("b", "L", "VIRA HOLM", 1), ("c", "M", "Vira Holm", 0), ("d", "L", None, 0), ("e", "L", "Odo Brandt", 5)], PERSON)
    assert {r.action for r in orders.take_orders(spark, path, people, at).collect()} == {"proceed"}
    rows = [("o1", "L", "Vira Holm", 1, "active", None), ("o2", "L", "Odo Brand", 1, "completed", D(2023, 1, 1)), ("o3", "N", "Vira Holm", 1, "active", None)]
    assert stores.commit(spark, path, spark.createDataFrame(rows, ORDER), "test", 0)
    first = {r.person_id: r.action for r in orders.take_orders(spark, path, people, at).collect()}
    assert first == {"a": "proceed", "b": "create_new", "c": "proceed", "d": "proceed", "e": "proceed"}
    assert {r.order_id: (r.status, r.completed_at) for r in stores.read_current(spark, path).collect()} == {"o1": ("completed", D(2024, 1, 7)), "o2": ("completed", D(2023, 1, 1)), "o3": ("active", None)}
    assert {r.action for r in orders.take_orders(spark, path, people, at).collect()} == {"proceed"} and stores.current_number(spark, path) == 2


def test_an_order_goes_to_who_writes_first(spark, tmp_path, monkeypatch):
    """While one run has made its claims, another one takes the order."""
    path, at = str(tmp_path / "orders"), F.lit(D(2024, 1, 7))
    one, two = (spark.createDataFrame([(p, "L", "Vira Holm", 1)], PERSON) for p in "ab")
    stores.commit(spark, path, spark.createDataFrame([("o1", "L", "Vira Holm", 1, "active", None)], ORDER), "test", 0)
    kept, between = orders.commit, []

    def late(*args):
        if not between:
            between.append(None)
            between[0] = orders.take_orders(spark, path, two, at).first().action
        return kept(*args)

    monkeypatch.setattr(orders, "commit", late)
    assert orders.take_orders(spark, path, one, at).first().action == "proceed" and between == ["create_new"]
    assert stores.current_number(spark, path) == 2


def test_of_two_writers_from_one_version_one_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    stores.safe_overwrite(spark, path, spark.range(3), "a")
    base = stores.current_number(spark, path)
    stores.safe_overwrite(spark, path, spark.range(4), "b", base=base)
    with pytest.raises(stores.Conflict):
        stores.safe_overwrite(spark, path, spark.range(5), "c", base=base)
    assert not stores.commit(spark, path, spark.range(6), "d", base) and stores.read_current(spark, path).count() == 4
    assert {r.caller: r.status for r in spark.read.parquet(f"{path}/audit").collect()} == {"a": "ok", "b": "ok", "c": "failed"}
    assert not stores.create_once(spark, f"{path}/log/1", "{}") and stores.current_number(spark, path) == 2
    (tmp_path / "t/log/3").write_text('{"version": "half')  # a writer that is not done, or died
    assert stores.current_number(spark, path) == 2 and stores.read_current(spark, path).count() == 4


def test_clean_up_keeps_what_is_in_force_and_what_is_young(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3):
        stores.safe_overwrite(spark, path, spark.range(n), "a")
    with pytest.raises(ValueError):
        stores.safe_overwrite(spark, path, spark.range(9), "b", lambda d: "no")
    assert stores.clean_up(spark, path) == [] and len(list((tmp_path / "t/data").iterdir())) == 4
    assert len(stores.clean_up(spark, path, keep=2, older_than=-60)) == 2
    assert stores.read_current(spark, path).count() == 3 and len(list((tmp_path / "t/data").iterdir())) == 2
    assert stores.clean_up(spark, str(tmp_path / "none")) == []


# --- streams

STREAM = "who string, place string, ts timestamp"
START = pd.Timestamp(2024, 1, 1)


def visits(n=400, people=7, seed=4):
    """(hours after START, who, place) in order of time; one person stops with a change pending."""
    rng = random.Random(seed)
    rows = [(h, f"p{rng.randrange(people)}", rng.choice("AAAB")) for h in sorted(rng.sample(range(n * 5), n))]
    return [*[r for r in rows if r[1] != "p0"], (20, "p0", "A"), (30, "p0", "B")]


def plain_moves(rows, end, needed, days):
    """The rule, person by person, over rows in order and up to a moment."""
    out = []
    for who in sorted({r[1] for r in rows}):
        home, cand, since, n = None, None, None, 0
        for h, _, place in [*sorted(r for r in rows if r[1] == who and r[0] < end), (end, who, None)]:
            if cand and h > since + 24 * days:
                out.append((who, home, cand, since, "expired"))
                cand, since, n = None, None, 0
            if place is None:
                continue
            if home in (None, place):
                home, cand, since, n = place, None, None, 0
                continue
            cand, since, n = (cand, since, n + 1) if cand == place else (place, h, 1)
            if n == needed:
                out.append((who, home, place, h, "confirmed"))
                home, cand, since, n = place, None, None, 0
    return sorted(out)


def run_stream(spark, folder, files=1):
    stream = spark.readStream.schema(STREAM).option("maxFilesPerTrigger", files).parquet(f"{folder}/in")
    out = ingest.timed_grace_period(stream, "who", "place", "ts", late="10 days", needed=2, days=3)
    out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()


def moves_of(spark, folder):
    return sorted((r.who, r.from_place, r.to_place, round((pd.Timestamp(r.seen) - START).total_seconds() / 3600), r.how) for r in spark.read.parquet(f"{folder}/out").collect())


def put(spark, folder, rows):
    df = spark.createDataFrame([(w, p, (START + pd.Timedelta(hours=h)).to_pydatetime()) for h, w, p in rows], STREAM)
    df.coalesce(1).write.mode("append").parquet(f"{folder}/in")


def test_shuffled_batches_pending_moves_and_a_restart(spark, tmp_path):
    rows = visits()
    rng = random.Random(9)
    shuffled = sorted(rows, key=lambda r: r[0] + rng.uniform(0, 100))  # less than ten days apart
    parts = [shuffled[i : i + 140] for i in range(0, len(shuffled), 140)]
    for part in parts[:2]:
        put(spark, tmp_path, part)
    run_stream(spark, tmp_path)
    before = moves_of(spark, tmp_path)
    for part in parts[2:]:
        put(spark, tmp_path, part)
    put(spark, tmp_path, [(5, "p1", "Z")])  # much too late: dropped
    run_stream(spark, tmp_path)  # a new query from the checkpoint
    end = max(r[0] for r in rows) - 240
    want = plain_moves(rows, end, 2, 3)
    got = moves_of(spark, tmp_path)
    assert got == want and 0 < len(before) < len(got) and set(before) <= set(got)
    assert ("p0", "A", "B", 30, "expired") in got and {r[-1] for r in got} == {"confirmed", "expired"}


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    put(spark, tmp_path, [(1, "a", "A"), (1, "a", "A"), (2, "b", "A")])
    stream = lambda: spark.readStream.schema(STREAM).parquet(f"{tmp_path}/in")
    take = lambda: ingest.stream_once(stream(), f"{tmp_path}/ledger", f"{tmp_path}/c", ["who", "place"], "ts", "5 days")
    take()
    count = lambda: spark.read.parquet(f"{tmp_path}/ledger").count()
    assert count() == 2
    put(spark, tmp_path, [(3, "a", "A"), (4, "c", "A")])
    take()
    assert count() == 3
    last = max((tmp_path / "ledger").glob("batch=*"), key=lambda p: int(p.name.split("=")[1]))
    number = int(last.name.split("=")[1])
    again = spark.read.parquet(str(last))
    rows = spark.createDataFrame(again.collect(), again.schema)
    ingest.write_batch(rows, number, f"{tmp_path}/ledger")  # as after a crash between the sink and the checkpoint
    assert count() == 3
