"""Orders that people give about moves, in two times: when something is true, and since when it is known.

A move is a detected event. Orders revert it, confirm it, or give the day from which it counts; they are rows of their own table and are
never applied in place. `versions` reads both into rows that say what was known of a move from one moment to the next, so any past reading
can be had again: where a person was on one day, as known on another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.people import MATCH, moves, similar_pairs
from tallyloom.operators.rounds import claims
from tallyloom.operators.stores import commit, current_number, read_current
from tallyloom.sources import facts
from tallyloom.sources.work import stored, tasks, work_folder

# Kinds of orders and the states that they lead to.
KINDS = {"revert": "INVALID", "confirm": "CONFIRMED", "effective_date": None}
DETECTED = "DETECTED"


def versions(events: DataFrame, orders: DataFrame) -> DataFrame:
    """(event_id, person, from_loc, to_loc, day, status, effective_day, timing, known_from, known_to) of every state of knowledge of each event.

    events(event_id, person, from_loc, to_loc, day, known) and orders(event_id, order_id, kind, effective_day, given). Later orders go
    before earlier ones of their kind: the last revert or confirm decides the status, the last effective date the day. Orders of one moment
    count in the order of their ids and give one version. Orders of other kinds, of unknown events or without a moment are left out; one
    given before its event was known holds from when that is. known_to is null for what is known now.
    """
    kind = F.col("kind")
    status = F.create_map(*(F.lit(x) for k, s in KINDS.items() if s for x in (k, s)))
    given = orders.where(kind.isin(*KINDS) & F.col("given").isNotNull())
    given = given.select("event_id", "order_id", "given", status[kind].alias("_status"), F.when(kind == "effective_date", F.col("effective_day")).alias("_day"))
    keep = ["event_id", "person", "from_loc", "to_loc", "day", "known"]
    rows = events.select(*keep, F.array(F.struct(F.lit(None).cast(orders.schema["order_id"].dataType).alias("order_id"), F.col("known").alias("at"), F.lit(DETECTED).alias("_status"), F.lit(None).cast("date").alias("_day"))).alias("_o")).select(*keep, F.inline("_o"))
    later = events.select(*keep).join(given, "event_id").select(*keep, "order_id", F.greatest("given", "known").alias("at"), "_status", "_day")
    w = Window.partitionBy("event_id").orderBy("at", F.col("order_id").asc_nulls_first())
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.unionByName(later).withColumns({"status": F.last("_status", True).over(so_far), "_said": F.last("_day", True).over(so_far), "_next": F.lead("at").over(w)})
    rows = rows.where("_next IS NULL OR _next > at")
    timing = F.when(F.col("_said").isNull(), "week_ending").otherwise("exact")
    return rows.select("event_id", "person", "from_loc", "to_loc", "day", "status", F.coalesce("_said", "day").alias("effective_day"), timing.alias("timing"), F.col("at").alias("known_from"), F.col("_next").alias("known_to"))


def as_known(history: DataFrame, on: Column) -> DataFrame:
    """The versions that were known on a day."""
    return history.where((F.col("known_from") <= on) & (F.col("known_to").isNull() | (F.col("known_to") > on)))


def stays(known: DataFrame) -> DataFrame:
    """(person, loc_name, valid_from, valid_to) of as_known rows: each valid move holds until the person's next valid one; reverted ones never were."""
    w = Window.partitionBy("person").orderBy("effective_day", "day", "event_id")
    rows = known.where("status <> 'INVALID'").select("person", F.col("to_loc").alias("loc_name"), F.col("effective_day").alias("valid_from"), F.lead("effective_day").over(w).alias("valid_to"), "event_id")
    return rows.where("valid_to IS NULL OR valid_to > valid_from")


def where_was(history: DataFrame, questions: DataFrame) -> DataFrame:
    """questions(question, person, on_day, as_of) with loc_name: where the person was on one day, as known on the other. A question has one row.

    An interval join within the person: of the versions known at as_of that were valid by on_day, the last one. Without any, where the
    person's first event known by then came from; null if nothing was known. Rows of both that are dealt by person stay where they are.
    """
    q = questions.select("question", "person", "on_day", "as_of")
    v = history.select(F.col("person").alias("_person"), "event_id", "from_loc", "to_loc", "day", "status", "effective_day", "known_from", "known_to")
    known = q.join(v, (F.col("person") == F.col("_person")) & (F.col("known_from") <= F.col("as_of")), "left")
    holds = (F.col("status") != "INVALID") & (F.col("known_to").isNull() | (F.col("known_to") > F.col("as_of"))) & (F.col("effective_day") <= F.col("on_day"))
    last = F.max_by("to_loc", F.when(holds, F.struct("effective_day", "day", "event_id")))
    first = F.min_by("from_loc", F.when(F.col("_person").isNotNull(), F.struct("day", "event_id")))
    return known.groupBy(*q.columns).agg(F.coalesce(last, first).alias("loc_name"))


def due(people: DataFrame, orders: DataFrame, least: float = MATCH) -> DataFrame:
    """(person_id, order_id): who must get a new id, and the active order that says so, each of them once.

    people(person_id, loc_name, name, seq) and orders(order_id, loc_name, name, created, status). People come in the order of seq, and
    each takes the first active order of their location whose name is similar enough. Names are compared without regard to case.
    """
    p = people.select("person_id", "loc_name", F.lower("name").alias("name"), "seq").where("name IS NOT NULL")
    o = orders.where("status = 'active' AND name IS NOT NULL").select("order_id", "loc_name", F.lower("name").alias("known_name"), "created")
    alike = similar_pairs(p, o, "loc_name", least)
    pairs = alike.join(p, ["loc_name", "name"]).join(o, ["loc_name", "known_name"])
    return claims(pairs, "person_id", "order_id", F.col("seq"), F.col("created"))


def take_orders(spark, path: str, people: DataFrame, at: Column, tries: int = 5) -> DataFrame:
    """people with action, create_new or proceed; the orders that were taken are completed in the versioned table at path.

    The new state is written only if the table is still the one that was read; if another writer was first, the claims are made again from
    what that one left. So an order is taken once, by whichever run wrote first, and people of a run that did not write take nothing.
    """
    for _ in range(tries):
        base = current_number(spark, path)
        orders = read_current(spark, path)
        if orders is None:
            return people.withColumn("action", F.lit("proceed"))
        taken = due(people, orders)
        done = orders.join(taken.select("order_id", F.lit(True).alias("_taken")), "order_id", "left")
        done = done.withColumns({"status": F.when(F.col("_taken"), "completed").otherwise(F.col("status")), "completed_at": F.when(F.col("_taken"), at).otherwise(F.col("completed_at"))})
        if taken.isEmpty() or commit(spark, path, done.select(orders.columns), "take_orders", base):
            action = F.when(F.col("_new"), "create_new").otherwise("proceed")
            return people.join(taken.select("person_id", F.lit(True).alias("_new")), "person_id", "left").withColumn("action", action).drop("_new")
    raise RuntimeError(f"{tries} times another writer was first")


# --- queries: moves between orders' locations, with orders given about a part of them


def _events(spark, sf_dir) -> DataFrame:
    m = moves(facts.visits(spark, sf_dir))
    return m.select(F.col("visit").alias("event_id"), "person", "from_loc", "to_loc", "day", F.date_add("day", 3).alias("known"))


def _orders(events: DataFrame) -> DataFrame:
    """By the remainder of the event's number: reverted and later confirmed after all, reverted, dated twice, dated back to before it was
    known, confirmed and dated at one moment."""
    k = F.col("event_id") % 7
    order = lambda n, kind, days, shift=0: F.struct(F.lit(n).alias("n"), F.lit(kind).alias("kind"), F.lit(days).alias("days"), F.lit(shift).alias("shift"))
    given = (
        F.when(k == 0, F.array(order(1, "revert", 10), order(2, "confirm", 40))).when(k == 1, F.array(order(1, "revert", 20)))
        .when(k == 2, F.array(order(1, "effective_date", 5, -7), order(2, "effective_date", 30, -400)))
        .when(k == 3, F.array(order(1, "effective_date", -50, -14))).when(k == 4, F.array(order(1, "confirm", 8), order(2, "effective_date", 8, 2), order(3, "advice", 9)))
    )
    rows = events.select("event_id", "day", F.inline(given))
    return rows.select("event_id", F.concat_ws("-", "event_id", "n").alias("order_id"), "kind", F.when(F.col("kind") == "effective_date", F.date_add("day", F.col("shift"))).alias("effective_day"), F.date_add("day", F.col("days")).alias("given"))


def _history(spark, sf_dir) -> DataFrame:
    e = _events(spark, sf_dir)
    return versions(e, _orders(e))


def order_versions(spark, sf_dir):
    """Every state of knowledge of each move."""
    return _history(spark, sf_dir).select("event_id", "status", "effective_day", "timing", "known_from", "known_to")


def manual_actions(spark, sf_dir):
    """Moves as known now, after all orders."""
    now = _history(spark, sf_dir).where("known_to IS NULL")
    stands = F.when(F.col("status") == "INVALID", F.col("from_loc")).otherwise(F.col("to_loc"))
    return now.select("person", F.col("event_id").alias("visit"), "status", "effective_day", "timing", stands.alias("stands_at"))


def stays_as_known(spark, sf_dir):
    """Where everybody was and when, as known at the end of June 1996."""
    known = as_known(_history(spark, sf_dir), F.lit("1996-06-30").cast("date"))
    return stays(known).select("person", "event_id", "loc_name", "valid_from", "valid_to")


def place_as_known(spark, sf_dir):
    """For each move, where the person was on that day, as known twelve and sixty days later."""
    e = stored(_events(spark, sf_dir), work_folder(spark))
    n = tasks(e, facts.ORDERS)
    history = versions(e.repartition(n, "event_id"), _orders(e).repartition(n, "event_id"))
    q = e.select(F.explode(F.array(F.lit(12), F.lit(60))).alias("later"), "*").select(F.concat_ws("/", "event_id", "later").alias("question"), "person", F.col("day").alias("on_day"), F.date_add("day", F.col("later")).alias("as_of"))
    return where_was(history.repartition(n, "person"), q.repartition(n, "person")).select("question", "loc_name")


def revert_check(spark, sf_dir):
    """Two runs of two people a supplier, with names like an ordered one's, against revert orders: of every fifth supplier one is active,
    of every tenth two, and of others one is completed. An order is taken once, so the second run takes what the first left."""
    path = work_folder(spark, "orders")
    p = facts.places(spark, sf_dir).select("loc_name", "s_suppkey", F.substring(F.translate(F.md5(F.col("stylist_name").cast("binary")), "0123456789", "ghijklmnop"), 1, 12).alias("name"))
    n = F.when(F.col("s_suppkey") % 10 == 0, F.array(F.lit(1), F.lit(2))).when(F.col("s_suppkey") % 5 < 2, F.array(F.lit(1)))
    orders = p.select("*", F.explode(n).alias("n")).select(F.concat_ws("-", "s_suppkey", "n").alias("order_id"), "loc_name", "name", F.col("n").alias("created"), F.when(F.col("s_suppkey") % 5 == 0, "active").otherwise("completed").alias("status"), F.lit(None).cast("date").alias("completed_at"))
    commit(spark, path, orders, "query", 0)
    people = p.select("s_suppkey", "loc_name", "name", F.explode(F.array(F.lit("q"), F.lit("qz"))).alias("end"))
    people = people.select(F.concat("s_suppkey", "end").alias("person_id"), "loc_name", F.concat(F.upper("name"), "end").alias("name"), F.col("end").alias("seq"))
    out = [take_orders(spark, path, people, F.lit("1998-01-01").cast("date")).select("person_id", "loc_name", "action", F.lit(k).cast("long").alias("run")) for k in (1, 2)]
    return out[0].unionByName(out[1])


QUERIES = {f.__name__: f for f in (order_versions, manual_actions, stays_as_known, place_as_known, revert_check)}


def _oracle() -> dict[str, str]:
    from tallyloom.operators.transfers import _CTX

    # The same orders as columns, and each moment of knowledge as a row of its own: no fold over orders.
    know = f"""{_CTX}, e AS (SELECT visit AS event_id, person, from_loc, to_loc, day, day + 3 AS known, visit % 7 AS k FROM mv),
    t AS (SELECT *, known AS known_at FROM e UNION SELECT *, day + 10 FROM e WHERE k = 0 UNION SELECT *, day + 40 FROM e WHERE k = 0 UNION SELECT *, day + 20 FROM e WHERE k = 1
      UNION SELECT *, day + 5 FROM e WHERE k = 2 UNION SELECT *, day + 30 FROM e WHERE k = 2 UNION SELECT *, day + 8 FROM e WHERE k = 4),
    h AS (SELECT event_id, person, from_loc, to_loc, day, CASE WHEN k = 0 AND known_at >= day + 40 THEN 'CONFIRMED' WHEN k = 0 AND known_at >= day + 10 OR k = 1 AND known_at >= day + 20 THEN 'INVALID' WHEN k = 4 AND known_at >= day + 8 THEN 'CONFIRMED' ELSE 'DETECTED' END AS status,
      CASE WHEN k = 2 AND known_at >= day + 30 THEN day - 400 WHEN k = 2 AND known_at >= day + 5 THEN day - 7 WHEN k = 3 THEN day - 14 WHEN k = 4 AND known_at >= day + 8 THEN day + 2 ELSE day END AS effective_day,
      CASE WHEN k = 2 AND known_at >= day + 5 OR k = 3 OR k = 4 AND known_at >= day + 8 THEN 'exact' ELSE 'week_ending' END AS timing, known_at AS known_from, lead(known_at) OVER (PARTITION BY event_id ORDER BY known_at) AS known_to FROM t)"""
    return {
        "order_versions": f"WITH {know} SELECT event_id, status, effective_day, timing, known_from, known_to FROM h",
        "manual_actions": f"WITH {know} SELECT person, event_id AS visit, status, effective_day, timing, CASE WHEN status = 'INVALID' THEN from_loc ELSE to_loc END AS stands_at FROM h WHERE known_to IS NULL",
        "stays_as_known": f"""WITH {know}, s AS (SELECT person, event_id, to_loc AS loc_name, effective_day AS valid_from, lead(effective_day) OVER (PARTITION BY person ORDER BY effective_day, day, event_id) AS valid_to
  FROM h WHERE known_from <= DATE '1996-06-30' AND (known_to IS NULL OR known_to > DATE '1996-06-30') AND status <> 'INVALID') SELECT * FROM s WHERE valid_to IS NULL OR valid_to > valid_from""",
        "place_as_known": f"""WITH {know}, q AS (SELECT event_id || '/' || later AS question, person, day AS on_day, day + later AS as_of FROM e, (VALUES (12), (60)) l(later)),
b AS (SELECT question, arg_max(h.to_loc, (h.effective_day, h.day, h.event_id)) AS loc FROM q JOIN h USING (person) WHERE h.known_from <= as_of AND (h.known_to IS NULL OR h.known_to > as_of) AND h.status <> 'INVALID' AND h.effective_day <= on_day GROUP BY 1),
f AS (SELECT question, arg_min(e.from_loc, (e.day, e.event_id)) AS loc FROM q JOIN e USING (person) WHERE e.known <= as_of GROUP BY 1)
SELECT question, coalesce(b.loc, f.loc) AS loc_name FROM q LEFT JOIN b USING (question) LEFT JOIN f USING (question)""",
        "revert_check": f"""WITH {facts.LINES_SQL} SELECT s_suppkey || e AS person_id, loc_name, CASE WHEN run = 1 AND s_suppkey % 5 = 0 AND (e = 'q' OR s_suppkey % 10 = 0) THEN 'create_new' ELSE 'proceed' END AS action, run
FROM places, (VALUES ('q'), ('qz')) x(e), (VALUES (1), (2)) r(run)""",
    }


ORACLE = _oracle()
