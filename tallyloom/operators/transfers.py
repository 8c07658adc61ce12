"""Moves between locations as a workflow: guards, confidence, grace period, checks of volume, corrections and their audit trail.

All is one pass over a person's visits in order: what stood before a visit and what comes after it are windows within one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import kpi
from tallyloom.operators.people import closeness, moves, similarity, steps, to_100
from tallyloom.operators.trust import check
from tallyloom.sources import facts
from tallyloom.sources.tables import parquet
from tallyloom.sources.work import stored, tasks, work_folder

#: Confidence from which a move needs no review, and from which it needs no grace period.
SURE, FAST = 0.80, 0.90
#: Moves of a batch out of one location, in all, and pending, above which a batch is doubtful.
PER_LOCATION, PER_BATCH, PENDING = 3, 10, 20
#: Days up to a move within which a visit to the old location is an overlap; weeks of a pattern, and of those, with rows, that make a place regular.
RECENT, PATTERN, USUAL = 28, 4, 2
#: Days after which a pending move expires; visits that make a second home; days looked back for them; days of absence that end a stay.
EXPIRY, REGULAR, LOOK_BACK, AWAY = 14, 2, 364, 180
# Kinds of corrections.
CORRECTIONS = ("false_positive", "wrong_location", "wrong_date", "partial_correct")


def with_context(visits: DataFrame) -> DataFrame:
    """visits with the person's visit before and after, and how many of the visits of the last LOOK_BACK days, and of all then, were here."""
    w = Window.partitionBy("person").orderBy("day", "visit")
    days = F.datediff("day", F.lit("1970-01-01").cast("date"))
    back = lambda *keys: Window.partitionBy(*keys).orderBy("_d").rangeBetween(-LOOK_BACK, -1)
    rows = visits.withColumn("_d", days.cast("long"))
    rows = rows.withColumns({"next_loc": F.lead("loc_name").over(w), "next_day": F.lead("day").over(w), "n_here": F.count("*").over(back("person", "loc_name")), "n_all": F.count("*").over(back("person"))})
    return rows.drop("_d")


def confidence(name_similarity: Column, performance: Column, overlap: Column, volume: Column) -> Column:
    """0.02 to 1: how alike names, work and workload are, in steps, and whether the person was gone from the old location. Null: neutral."""
    name = F.when(name_similarity > 0.95, 0.30).when(name_similarity > 0.85, 0.20).otherwise(0.05)
    score = name + steps(performance, 0.70, 0.50, (0.25, 0.15, 0.05), 0.10) + F.when(overlap, 0.02).otherwise(0.20) + steps(volume, 0.80, 0.60, (0.25, 0.15, 0.05), 0.10)
    return F.round(score, 3)


def decided(m: DataFrame) -> DataFrame:
    """moves with a state, by the first rule that holds: a second home is no move; sure and gone from the old location needs no grace
    period; else the next visit confirms it, or leaves it to review, drops it, or has not come."""
    state = F.when(F.col("n_here") >= REGULAR, "secondary").when((F.col("score") >= FAST) & ~F.col("overlap"), "fast_tracked")
    state = state.when(F.col("next_loc").isNull(), "pending").when(F.col("next_loc") != F.col("to_loc"), "dropped").when(F.col("score") < SURE, "review").otherwise("confirmed")
    return m.withColumn("state", state)


def impact(ticket: Column, guests: Column) -> Column:
    """What mean changes of ticket and guests after moves to a location say of it; a missing change is none."""
    t, g = F.coalesce(ticket, F.lit(0.0)), F.coalesce(guests, F.lit(0.0))
    kind = F.when((t >= 0.10) & (g >= 0.10), "TALENT DEVELOPER").when((t >= 0.05) | (g >= 0.05), "POSITIVE IMPACT")
    return kind.when((t <= -0.10) | (g <= -0.10), "WARNING").otherwise("NEUTRAL")


def location_pattern(rows: DataFrame, weeks: int = PATTERN, usual: int = USUAL) -> DataFrame:
    """(person, week, primary_location, is_multi_location, secondary_locations, split) of rows(person, week, loc_name, n), for each week with rows.

    Over that week and those before it, `weeks` in all: the location with most rows is primary (ties by name), split is each one's share in
    thousandths. A person who was at two locations or more in at least `usual` of the weeks each works at several; those other than the
    primary are secondary. A row counts in each of the person's weeks that it is looked back to from, so there is no join of weeks with weeks.
    """
    own = rows.groupBy("person", "week", "loc_name").agg(F.sum("n").alias("n")).withColumn("_w", F.unix_date("week").cast("long"))
    later = F.collect_set("week").over(Window.partitionBy("person").orderBy("_w").rangeBetween(0, 7 * (weeks - 1)))
    seen = own.withColumn("at", later).select("person", "loc_name", "n", F.explode("at").alias("at"))
    per = seen.groupBy("person", "at", "loc_name").agg(F.sum("n").alias("n"), F.count("*").alias("weeks"))
    places = F.collect_list(F.struct("loc_name", "n", "weeks"))
    out = per.groupBy("person", F.col("at").alias("week")).agg(F.array_sort(places).alias("p"), F.sum("n").alias("total"))
    first = F.array_sort(F.transform("p", lambda x: F.struct((-x["n"]).alias("n"), x["loc_name"].alias("loc_name"))))[0]["loc_name"]
    out = out.withColumn("primary_location", first).withColumn("_usual", F.transform(F.filter("p", lambda x: x["weeks"] >= usual), lambda x: x["loc_name"]))
    multi = F.size("_usual") >= 2
    others = F.filter("_usual", lambda x: x != F.col("primary_location"))
    split = F.array_join(F.transform("p", lambda x: F.concat_ws(":", x["loc_name"], F.floor(x["n"] * 1000 / F.col("total")).cast("string"))), ";")
    return out.select("person", "week", "primary_location", multi.alias("is_multi_location"), F.when(multi & (F.size(others) > 0), F.array_join(others, ";")).alias("secondary_locations"), split.alias("split"))


def batch_checks(batch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, name, status, severity) of moves(keys, from_loc, score, state): volume a location and in all, doubtful ones, the pending queue."""
    per = batch.groupBy(*keys, "from_loc").agg(F.count("*").alias("n"), F.count_if(F.col("score") < SURE).alias("low"), F.count_if(F.col("state") == "pending").alias("pending"))
    out = per.groupBy(*keys).agg(F.sum("n").alias("n"), F.count_if(F.col("n") > PER_LOCATION).alias("crowded"), F.sum("low").alias("low"), F.sum("pending").alias("pending"))
    c = F.col
    checks = [
        check("location_volume", (c("crowded") > 0, "warn", 15)), check("batch_volume", (c("n") > PER_BATCH, "warn", 20)),
        check("confidence", (c("low") > 0, "warn", 10)), check("pending_queue", (c("pending") > PENDING, "warn", 5)),
    ]
    return out.select(*keys, F.inline(F.array(*checks)))


def correct(events: DataFrame, corrections: DataFrame) -> DataFrame:
    """The log with corrections(event_id, kind, reason, location, day) appended: each supersedes its event and has the next version.

    A false positive corrects to nothing, a wrong location keeps the day, a wrong day keeps the location, a partial one takes both as given.
    """
    c = corrections.where(F.col("kind").isin(*CORRECTIONS)).select("event_id", "kind", "reason", "location", F.col("day").alias("_day"))
    new_id = F.concat(F.col("event_id"), F.lit("-c"))
    both = events.join(c, "event_id", "left")
    base = [x for x in events.columns if x not in ("event_id", "version", "status")]
    null = lambda kind: F.lit(None).cast(kind)
    old = both.select("event_id", "version", F.when(F.col("kind").isNull(), F.col("status")).otherwise("superseded").alias("status"), *base, F.when(F.col("kind").isNotNull(), new_id).alias("superseded_by"), null("string").alias("corrects"), null("string").alias("kind"), null("string").alias("reason"), null("string").alias("corrected_loc"), null("date").alias("corrected_day"))
    k = F.col("kind")
    loc = F.when(k == "wrong_date", F.col("to_loc")).when(k != "false_positive", F.col("location"))
    day = F.when(k == "wrong_location", F.col("day")).when(k != "false_positive", F.col("_day"))
    new = both.where("kind IS NOT NULL").select(new_id.alias("event_id"), (F.col("version") + 1).alias("version"), F.lit("active").alias("status"), *base, null("string").alias("superseded_by"), F.col("event_id").alias("corrects"), "kind", "reason", loc.alias("corrected_loc"), day.alias("corrected_day"))
    return old.unionByName(new)


def audit_trail(log: DataFrame) -> DataFrame:
    """Every event of the corrected log in its person's order, corrections with the confidence of what they correct.

    Only corrections look that up: rows without one to look up would all meet in one task. The log is counted, so it should be a stored one.
    """
    n = tasks(log, facts.ORDERS)
    none = F.lit(None).cast(log.schema["score"].dataType)
    original = log.select(F.col("event_id").alias("corrects"), F.col("score").alias("original_score")).repartition(n, "corrects")
    made = log.where("corrects IS NOT NULL").repartition(n, "corrects").withColumn("score", none).join(original, "corrects", "left")
    out = log.where("corrects IS NULL").withColumn("original_score", none).unionByName(made).repartition(n, "person")
    w = Window.partitionBy("person").orderBy("day", "visit", "version")
    return out.select("person", F.row_number().over(w).cast("long").alias("place"), F.when(F.col("corrects").isNull(), "Transfer Detected").otherwise("Correction Applied").alias("event"), "event_id", "version", "status", "score", "original_score", "kind", "corrected_loc", "corrected_day")


def _scored(spark, sf_dir) -> DataFrame:
    """Moves with context and confidence; names differ by the person's number, and volume and work are those of the two visits."""
    v = with_context(facts.visits(spark, sf_dir))
    m = moves(v)
    known = F.concat(F.lit("person "), F.translate(F.col("person").cast("string"), "0123456789", "abcdefghij"))
    k = F.col("person") % 10
    typed = F.when(k < 7, known).when(k < 9, F.concat(known, F.lit("xy"))).otherwise("zzzzzzzz")
    like = (closeness(F.col("prior_revenue"), F.col("revenue")) + closeness(F.col("prior_lines"), F.col("n_lines"))) / 2
    volume = closeness(F.col("prior_lines"), F.col("n_lines")) * 0.4 + closeness(F.col("prior_revenue"), F.col("revenue")) * 0.6
    seen = F.datediff("day", "prior_day") <= RECENT  # the visit before is the last one at the old location
    names = m.select("person").distinct().withColumn("name_similarity", similarity(typed, known))  # one comparison a person
    m = m.join(names, "person").withColumns({"performance": like, "volume": volume, "overlap": seen})
    return decided(m.withColumn("score", confidence(F.col("name_similarity"), F.col("performance"), F.col("overlap"), F.col("volume"))))


def transfer_confidence(spark, sf_dir):
    return _scored(spark, sf_dir).select("person", "visit", "overlap", "score", (F.col("score") < SURE).alias("needs_confirmation"))


def multi_location_guard(spark, sf_dir):
    """For each move the share of the person's visits of the last year at the new location, and whether it is a second home already."""
    m = moves(with_context(facts.visits(spark, sf_dir)))
    return m.select("person", "visit", "to_loc", "n_here", "n_all", kpi.ratio(F.col("n_here"), F.col("n_all")).alias("share"), (F.col("n_here") < REGULAR).alias("is_transfer"))


def multi_location_pattern(spark, sf_dir):
    """Where the lines that each customer bought in a week and the three before it came from."""
    orders = parquet(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("person"))
    rows = facts.lines(spark, sf_dir).join(orders.hint("shuffle_hash"), "l_orderkey").select("person", "loc_name", F.next_day(F.date_sub("day", 1), "SU").alias("week"), F.lit(1).alias("n"))
    return location_pattern(rows.repartition(tasks(orders, facts.ORDERS), "person"))


def transfer_detection(spark, sf_dir):
    return _scored(spark, sf_dir).select("person", "visit", "from_loc", "to_loc", "state")


def transfer_checks(spark, sf_dir):
    return batch_checks(_scored(spark, sf_dir).withColumn("year_month", facts.year_month(F.col("day"))), ["year_month"])


def transfer_counts(spark, sf_dir):
    """Moves out of each location by month, those of low confidence among them."""
    m = _scored(spark, sf_dir).withColumn("year_month", facts.year_month(F.col("day")))
    return m.groupBy("year_month", "from_loc").agg(F.count("*").alias("n"), F.count_if(F.col("score") < SURE).alias("n_low"))


def _log(spark, sf_dir) -> DataFrame:
    events = moves(facts.visits(spark, sf_dir)).select(F.concat(F.lit("t"), F.col("visit")).alias("event_id"), F.lit(1).cast("long").alias("version"), F.lit("active").alias("status"), "person", "visit", "from_loc", "to_loc", "day", F.round(closeness(F.col("prior_revenue"), F.col("revenue")), 3).alias("score"))
    events = stored(events, work_folder(spark))
    n = tasks(events, facts.ORDERS)
    kind = F.element_at(F.array(*map(F.lit, CORRECTIONS)), (F.col("visit") % 4 + 1).cast("int"))
    given = events.where("visit % 5 = 0").select("event_id", kind.alias("kind"), F.lit("checked").alias("reason"), F.lit("NATION_0").alias("location"), F.date_add("day", 7).alias("day"))
    return correct(events.repartition(n, "event_id"), given.repartition(n, "event_id"))


def transfer_corrections(spark, sf_dir):
    return _log(spark, sf_dir).select("event_id", "version", "status", "superseded_by", "corrects", "kind", "corrected_loc", "corrected_day")


def transfer_audit_trail(spark, sf_dir):
    return audit_trail(stored(_log(spark, sf_dir), work_folder(spark)))


def weekly_enrichment(spark, sf_dir):
    """Each visit with whether it is the first at its location after a move, from where, and the weeks since the person first came."""
    w = Window.partitionBy("person").orderBy("day", "visit")
    v = facts.visits(spark, sf_dir).withColumns({"before": F.lag("loc_name").over(w), "hired": F.min("day").over(Window.partitionBy("person"))})
    moved = F.coalesce(F.col("before") != F.col("loc_name"), F.lit(False))
    return v.select("person", "visit", moved.alias("is_transfer"), F.when(moved, F.col("before")).alias("transferred_from"), F.floor(F.datediff("day", "hired") / 7).cast("long").alias("tenure_weeks"))


def departures_and_returns(spark, sf_dir):
    """Stays end after AWAY days without a visit; who comes back is reactivated where they come back, and that is no transfer."""
    w = Window.partitionBy("person").orderBy("day", "visit")
    v = facts.visits(spark, sf_dir).withColumns({"before": F.lag("loc_name").over(w), "last_seen": F.lag("day").over(w)}).where(F.datediff("day", "last_seen") > AWAY)
    return v.select("person", "visit", F.col("before").alias("from_loc"), F.col("loc_name").alias("to_loc"), F.datediff("day", "last_seen").cast("long").alias("days_absent"), F.lit("reactivation").alias("kind"))


def pending_queue(spark, sf_dir):
    """Moves without a later visit: expired if older than EXPIRY days at the end of the table."""
    m = moves(with_context(facts.visits(spark, sf_dir))).where("next_loc IS NULL")
    end = facts.visits(spark, sf_dir).agg(F.max("day").alias("d")).scalar()
    return m.select("person", "visit", "to_loc", F.when(F.datediff(end, "day") > EXPIRY, "expired").otherwise("pending").alias("state"))


def temporary_coverage(spark, sf_dir):
    """Single visits away from the location before and after them."""
    m = moves(with_context(facts.visits(spark, sf_dir)))
    return m.select("person", "visit", "to_loc", F.coalesce(F.col("next_loc") == F.col("from_loc"), F.lit(False)).alias("coverage"))


def location_transfer_impact(spark, sf_dir):
    """Mean relative changes of revenue and lines over the moves to each location."""
    m = moves(facts.visits(spark, sf_dir)).withColumns({c: F.try_divide((F.col(a) - F.col(b)).cast("double"), F.col(b).cast("double")) for c, a, b in (("r", "revenue", "prior_revenue"), ("n", "n_lines", "prior_lines"))})
    out = m.groupBy(F.col("to_loc").alias("loc_name")).agg(F.count("*").alias("n_moves"), kpi.mean(F.col("r")).alias("revenue_change"), kpi.mean(F.col("n")).alias("lines_change"))
    return out.withColumn("verdict", impact(F.col("revenue_change"), F.col("lines_change")))


def location_effect_rank(spark, sf_dir):
    """Composite of four quarters, what moves change in revenue, lines and return visits and how many newcomers stay, and its rank."""
    v = facts.visits(spark, sf_dir)
    w = Window.partitionBy("person").orderBy("day", "visit")
    last = v.groupBy("person").agg(F.max_by("loc_name", F.struct("day", "visit")).alias("last_loc"))
    gaps = v.withColumns({"gap_before": F.datediff("day", F.lag("day").over(w)), "gap_after": F.datediff(F.lead("day").over(w), "day")})
    m = moves(gaps).join(last, "person")
    part = lambda a, b: F.try_divide((F.col(a) - F.col(b)).cast("double"), F.col(b).cast("double"))
    sooner = F.try_divide((F.col("gap_before") - F.col("gap_after")).cast("double"), F.col("gap_before").cast("double"))
    out = m.groupBy(F.col("to_loc").alias("loc_name")).agg(kpi.mean(part("revenue", "prior_revenue")).alias("ticket_effect"), kpi.mean(part("n_lines", "prior_lines")).alias("guest_effect"), kpi.mean(sooner).alias("rebooking_effect"), kpi.ratio(F.count_if(F.col("last_loc") == F.col("to_loc")), F.count("*")).alias("retention"))
    whole = sum((to_100(F.coalesce(c, F.lit(0.0)), -0.2, 0.2) * 0.25 for c in ("ticket_effect", "guest_effect", "rebooking_effect")), F.lit(0.0)) + F.col("retention") * 25
    out = out.withColumn("effect_score", F.floor(whole + 0.5).cast("long"))
    return out.withColumn("place", F.row_number().over(Window.orderBy(F.col("effect_score").desc(), "loc_name")).cast("long"))


def transfer_net(spark, sf_dir):
    """Moves of every pair of locations, with those the other way and the difference."""
    n = moves(facts.visits(spark, sf_dir)).groupBy("from_loc", "to_loc").agg(F.count("*").alias("n"))
    back = n.select(F.col("to_loc").alias("from_loc"), F.col("from_loc").alias("to_loc"), F.col("n").alias("n_back"))
    return n.join(back, ["from_loc", "to_loc"], "left").select("from_loc", "to_loc", "n", F.coalesce("n_back", F.lit(0)).cast("long").alias("n_back"), (F.col("n") - F.coalesce("n_back", F.lit(0))).cast("long").alias("net"))


QUERIES = {
    f.__name__: f
    for f in (
        transfer_confidence, multi_location_guard, multi_location_pattern, transfer_detection, transfer_checks, transfer_counts, transfer_corrections, transfer_audit_trail, weekly_enrichment,
        departures_and_returns, pending_queue, temporary_coverage, location_transfer_impact, location_effect_rank, transfer_net,
    )
}

_CTX = f"""{facts.VISITS_SQL},
ctx AS (SELECT *, lag(loc_name) OVER w AS from_loc, lag(revenue) OVER w AS prior_revenue, lag(n_lines) OVER w AS prior_lines, lag(day) OVER w AS prior_day, lead(loc_name) OVER w AS next_loc, lead(day) OVER w AS next_day,
  min(day) OVER (PARTITION BY person) AS hired,
  (SELECT count(*) FROM visits o WHERE o.person = v.person AND o.loc_name = v.loc_name AND o.day BETWEEN v.day - {LOOK_BACK} AND v.day - 1) AS n_here,
  (SELECT count(*) FROM visits o WHERE o.person = v.person AND o.day BETWEEN v.day - {LOOK_BACK} AND v.day - 1) AS n_all
  FROM visits v WINDOW w AS (PARTITION BY person ORDER BY day, visit)),
mv AS (SELECT * EXCLUDE (loc_name), loc_name AS to_loc FROM ctx WHERE from_loc <> loc_name)"""
_CLOSE = "(CASE WHEN {a} IS NULL OR {b} IS NULL OR {a} = 0 OR {b} = 0 THEN 0.5::DOUBLE WHEN least({a}, {b})::DOUBLE / greatest({a}, {b})::DOUBLE > 0.7::DOUBLE THEN least({a}, {b})::DOUBLE / greatest({a}, {b})::DOUBLE ELSE 0.3::DOUBLE END)"
_CR, _CN = _CLOSE.format(a="prior_revenue", b="revenue"), _CLOSE.format(a="prior_lines", b="n_lines")
_STEP = "CASE WHEN {v} > {h}::DOUBLE THEN 0.25::DOUBLE WHEN {v} > {l}::DOUBLE THEN 0.15::DOUBLE ELSE 0.05::DOUBLE END"
_SCORED = f"""{_CTX},
f AS (SELECT *, 7 + length(person::VARCHAR) AS n, ({_CR} + {_CN}) / 2 AS performance, {_CN} * 0.4::DOUBLE + {_CR} * 0.6::DOUBLE AS volume, day - prior_day <= {RECENT} AS overlap FROM mv),
g AS (SELECT *, round(CASE WHEN person % 10 < 7 THEN 0.3::DOUBLE WHEN person % 10 = 9 THEN 0.05::DOUBLE WHEN 2.0 * n / (2 * n + 2) > 0.95 THEN 0.3::DOUBLE WHEN 2.0 * n / (2 * n + 2) > 0.85 THEN 0.2::DOUBLE ELSE 0.05::DOUBLE END
  + {_STEP.format(v="performance", h=0.7, l=0.5)} + CASE WHEN overlap THEN 0.02::DOUBLE ELSE 0.2::DOUBLE END + {_STEP.format(v="volume", h=0.8, l=0.6)}, 3) AS score FROM f),
sc AS (SELECT *, strftime(day, '%Y-%m') AS year_month, CASE WHEN n_here >= {REGULAR} THEN 'secondary' WHEN score >= {FAST}::DOUBLE AND NOT overlap THEN 'fast_tracked' WHEN next_loc IS NULL THEN 'pending'
  WHEN next_loc <> to_loc THEN 'dropped' WHEN score < {SURE}::DOUBLE THEN 'review' ELSE 'confirmed' END AS state FROM g)"""
_LOG = f"""{_CTX},
e AS (SELECT 't' || visit AS event_id, 1 AS version, person, visit, to_loc, day, round({_CR}, 3) AS score, CASE WHEN visit % 5 = 0 THEN [{", ".join(f"'{k}'" for k in CORRECTIONS)}][visit % 4 + 1] END AS k FROM mv),
log AS (SELECT event_id, version, CASE WHEN k IS NULL THEN 'active' ELSE 'superseded' END AS status, CASE WHEN k IS NOT NULL THEN event_id || '-c' END AS superseded_by, NULL::VARCHAR AS corrects, NULL::VARCHAR AS kind,
    NULL::VARCHAR AS corrected_loc, NULL::DATE AS corrected_day, person, visit, day, score FROM e
  UNION ALL SELECT event_id || '-c', 2, 'active', NULL, event_id, k, CASE k WHEN 'wrong_date' THEN to_loc WHEN 'false_positive' THEN NULL ELSE 'NATION_0' END,
    CASE k WHEN 'wrong_location' THEN day WHEN 'false_positive' THEN NULL ELSE day + 7 END, person, visit, day, score FROM e WHERE k IS NOT NULL)"""
_EFF = "least(100.0::DOUBLE, greatest(0.0::DOUBLE, (coalesce({v}, 0) - -0.2::DOUBLE) / (0.2::DOUBLE - -0.2::DOUBLE) * 100)) * 0.25::DOUBLE"
ORACLE = {
    "transfer_confidence": f"WITH {_SCORED} SELECT person, visit, overlap, score, score < {SURE}::DOUBLE AS needs_confirmation FROM sc",
    "multi_location_guard": f"WITH {_CTX} SELECT person, visit, to_loc, n_here, n_all, coalesce(n_here::DOUBLE / nullif(n_all, 0), 0.0) AS share, n_here < {REGULAR} AS is_transfer FROM mv",
    "transfer_detection": f"WITH {_SCORED} SELECT person, visit, from_loc, to_loc, state FROM sc",
    "transfer_checks": f"""WITH {_SCORED}, p AS (SELECT year_month, from_loc, count(*) AS n, count(*) FILTER (score < {SURE}::DOUBLE) AS low, count(*) FILTER (state = 'pending') AS pending FROM sc GROUP BY 1, 2),
b AS (SELECT year_month, sum(n) AS n, count(*) FILTER (n > {PER_LOCATION}) AS crowded, sum(low) AS low, sum(pending) AS pending FROM p GROUP BY 1),
r AS (SELECT year_month, unnest([{{'name': 'location_volume', 'bad': crowded > 0, 'cost': 15}}, {{'name': 'batch_volume', 'bad': n > {PER_BATCH}, 'cost': 20}}, {{'name': 'confidence', 'bad': low > 0, 'cost': 10}},
  {{'name': 'pending_queue', 'bad': pending > {PENDING}, 'cost': 5}}]) AS x FROM b)
SELECT year_month, x.name AS name, CASE WHEN x.bad THEN 'warn' ELSE 'pass' END AS status, CASE WHEN x.bad THEN x.cost ELSE 0 END::BIGINT AS severity FROM r""",
    "transfer_counts": f"WITH {_SCORED} SELECT year_month, from_loc, count(*) AS n, count(*) FILTER (score < {SURE}::DOUBLE) AS n_low FROM sc GROUP BY 1, 2",
    "transfer_corrections": f"WITH {_LOG} SELECT event_id, version, status, superseded_by, corrects, kind, corrected_loc, corrected_day FROM log",
    "transfer_audit_trail": f"""WITH {_LOG} SELECT l.person, row_number() OVER (PARTITION BY l.person ORDER BY l.day, l.visit, l.version) AS place,
  CASE WHEN l.corrects IS NULL THEN 'Transfer Detected' ELSE 'Correction Applied' END AS event, l.event_id, l.version, l.status, CASE WHEN l.corrects IS NULL THEN l.score END AS score, o.score AS original_score, l.kind, l.corrected_loc, l.corrected_day
  FROM log l LEFT JOIN log o ON o.event_id = l.corrects""",
    "weekly_enrichment": f"""WITH {_CTX} SELECT person, visit, coalesce(from_loc <> loc_name, false) AS is_transfer, CASE WHEN from_loc <> loc_name THEN from_loc END AS transferred_from, (day - hired) // 7 AS tenure_weeks FROM ctx""",
    "departures_and_returns": f"WITH {_CTX} SELECT person, visit, from_loc, loc_name AS to_loc, day - prior_day AS days_absent, 'reactivation' AS kind FROM ctx WHERE day - prior_day > {AWAY}",
    "pending_queue": f"WITH {_CTX} SELECT person, visit, to_loc, CASE WHEN (SELECT max(day) FROM visits) - day > {EXPIRY} THEN 'expired' ELSE 'pending' END AS state FROM mv WHERE next_loc IS NULL",
    "temporary_coverage": f"WITH {_CTX} SELECT person, visit, to_loc, coalesce(next_loc = from_loc, false) AS coverage FROM mv",
    "location_transfer_impact": f"""WITH {_CTX}, t AS (SELECT to_loc AS loc_name, count(*) AS n_moves, {kpi.mean_sql("(revenue - prior_revenue)::DOUBLE / nullif(prior_revenue::DOUBLE, 0)")} AS revenue_change,
  {kpi.mean_sql("(n_lines - prior_lines)::DOUBLE / nullif(prior_lines::DOUBLE, 0)")} AS lines_change FROM mv GROUP BY 1)
SELECT *, CASE WHEN revenue_change >= 0.1::DOUBLE AND lines_change >= 0.1::DOUBLE THEN 'TALENT DEVELOPER' WHEN greatest(revenue_change, lines_change) >= 0.05::DOUBLE THEN 'POSITIVE IMPACT'
  WHEN least(revenue_change, lines_change) <= -0.1::DOUBLE THEN 'WARNING' ELSE 'NEUTRAL' END AS verdict FROM t""",
    "multi_location_pattern": f"""WITH {facts.LINES_SQL}, b AS (SELECT o_custkey AS person, loc_name, day + (7 - isodow(day))::INT AS week, count(*) AS n FROM lines JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL), a AS (SELECT DISTINCT person, week FROM b),
s AS (SELECT a.person, a.week, b.loc_name, sum(b.n) AS n, count(DISTINCT b.week) AS weeks FROM a JOIN b ON b.person = a.person AND b.week BETWEEN a.week - {7 * (PATTERN - 1)} AND a.week GROUP BY ALL),
p AS (SELECT person, week, arg_min(loc_name, (-n, loc_name)) AS primary_location, sum(n) AS total, count(*) FILTER (weeks >= {USUAL}) AS usual FROM s GROUP BY ALL)
SELECT person, week, primary_location, usual >= 2 AS is_multi_location, (SELECT string_agg(loc_name, ';' ORDER BY loc_name) FROM s WHERE s.person = p.person AND s.week = p.week AND weeks >= {USUAL} AND usual >= 2 AND loc_name <> primary_location) AS secondary_locations,
  (SELECT string_agg(loc_name || ':' || ((1000 * n) // total)::BIGINT, ';' ORDER BY loc_name) FROM s WHERE s.person = p.person AND s.week = p.week) AS split FROM p""",
    "location_effect_rank": f"""WITH {_CTX}, l AS (SELECT person, arg_max(loc_name, (day, visit)) AS last_loc FROM visits GROUP BY 1),
t AS (SELECT to_loc AS loc_name, {kpi.mean_sql("(revenue - prior_revenue)::DOUBLE / nullif(prior_revenue::DOUBLE, 0)")} AS ticket_effect, {kpi.mean_sql("(n_lines - prior_lines)::DOUBLE / nullif(prior_lines::DOUBLE, 0)")} AS guest_effect,
  {kpi.mean_sql("((day - prior_day) - (next_day - day))::DOUBLE / nullif((day - prior_day)::DOUBLE, 0)")} AS rebooking_effect, count(*) FILTER (last_loc = to_loc)::DOUBLE / count(*) AS retention FROM mv JOIN l USING (person) GROUP BY 1),
s AS (SELECT *, floor({_EFF.format(v="ticket_effect")} + {_EFF.format(v="guest_effect")} + {_EFF.format(v="rebooking_effect")} + retention * 25 + 0.5)::BIGINT AS effect_score FROM t)
SELECT *, row_number() OVER (ORDER BY effect_score DESC, loc_name) AS place FROM s""",
    "transfer_net": f"""WITH {_CTX}, n AS (SELECT from_loc, to_loc, count(*) AS n FROM mv GROUP BY 1, 2)
SELECT n.from_loc, n.to_loc, n.n, coalesce(b.n, 0) AS n_back, n.n - coalesce(b.n, 0) AS net FROM n LEFT JOIN n b ON b.from_loc = n.to_loc AND b.to_loc = n.from_loc""",
}
