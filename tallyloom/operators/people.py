"""Identity, moves between locations, and what they tell about people and places.

Moves are found by comparing each visit with the person's one before it, in one shuffle by person. Fuzzy names are compared only within a
location, by an Arrow-batched similarity.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import kpi, parsing
from tallyloom.sources import facts

MATCH, WEEKS, FLOW = 0.85, 4, 3


@F.pandas_udf(T.DoubleType())
def similarity(new: pd.Series, known: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; the order of the two matters."""
    return pd.Series([SequenceMatcher(None, a, b).ratio() if a is not None and b is not None else None for a, b in zip(new, known)])


similarity = similarity.asNondeterministic()  # else a filter on the ratio computes it once more


def _less(c: Column) -> Column:
    """A text without one of its letters, for each of them."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c)))))


def similar_pairs(new: DataFrame, known: DataFrame, block: str, least: float = MATCH) -> DataFrame:
    """(block, name, known_name, ratio) of the pairs of distinct names within a block whose ratio is at least `least`.

    In names of n and m letters at most d = n + m - 2 ceil(least (n + m) / 2) letters are unmatched, all others stand in the same order. If the
    known name is cut into d // 2 + 1 pieces, one of them meets its part of the new name with at most one unmatched letter. That part begins
    where the piece does, moved by no more letters than are unmatched on either side; the first begins and the last ends with the name. So
    pieces, whole and without one letter, are looked up, and only pairs that agree in one are compared.
    """
    many = new.sparkSession.sparkContext.defaultParallelism  # pieces are many times the names, so small names must not go to one task
    texts = lambda df, c: df.select(block, c).repartition(many, block, c).distinct().where(F.length(c) > 0)
    a, b = texts(new, "name").withColumn("_n", F.length("name")), texts(known, "known_name").withColumn("_m", F.length("known_name"))
    d = F.col("_n") + F.col("_m") - 2 * F.ceil((F.col("_n") + F.col("_m")) * (least / 2) - 1e-9)
    sizes = a.select(block, "_n").distinct().join(b.select(block, "_m").distinct(), block).withColumn("_d", d).where("_d >= abs(_n - _m)").withColumn("_k", F.expr("_d div 2 + 1"))
    pieces = lambda df: df.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_k") - 1))).withColumns({"_at": F.expr("int(_i * _m div _k) + 1"), "_p": F.expr("int((_i + 1) * _m div _k - _i * _m div _k)")})
    piece = F.substring(F.col("known_name"), F.col("_at"), F.col("_p"))
    b = pieces(b.join(sizes.select(block, "_m", "_k").distinct(), [block, "_m"])).select(block, "_m", "_k", "_i", "known_name", F.explode(F.array_union(F.array(piece), _less(piece))).alias("_piece"))
    a = pieces(a.join(sizes, [block, "_n"]))
    first, last = F.col("_i") == 0, F.col("_i") == F.col("_k") - 1
    moved = F.when(first | last, F.array(F.col("_at"))).otherwise(F.expr("sequence(greatest(1, int(_at - (_d - _n + _m) div 2)), greatest(1, int(_at + (_d + _n - _m) div 2)))"))
    a = a.withColumn("_at", F.explode(moved))
    part = lambda k: F.substring(F.col("name"), F.when(last & ~first, F.greatest(F.lit(1), F.col("_n") - k + 1)).otherwise(F.col("_at")), k)
    p = F.col("_p")
    a = a.select(block, "_m", "_k", "_i", "_d", "name", F.explode(F.array_union(F.array(part(p), part(p - 1)), _less(part(p + 1)))).alias("_piece"))
    pairs = a.join(b, [block, "_m", "_k", "_i", "_piece"]).where(F.levenshtein("name", "known_name") <= F.col("_d")).select(block, "name", "known_name").distinct()
    return pairs.withColumn("ratio", similarity(F.col("name"), F.col("known_name"))).where(F.col("ratio") >= least)


def one_letter_apart(new: DataFrame, known: DataFrame, block: str) -> DataFrame:
    """(block, name, known_name) of the pairs of which one is the other without one of its letters."""
    less = lambda c: F.explode(_less(F.col(c)))
    a, b = new.select(block, "name").distinct().where("length(name) > 1"), known.select(block, "known_name").distinct().where("length(known_name) > 1")
    shorter = a.select(block, "name", less("name").alias("known_name")).join(b, [block, "known_name"])
    longer = b.select(block, "known_name", less("known_name").alias("name")).join(a, [block, "name"])
    return shorter.select(block, "name", "known_name").unionByName(longer.select(block, "name", "known_name"))


def best_match(new: DataFrame, known: DataFrame, block: str, least: float = MATCH) -> DataFrame:
    """new(block, name) with the most similar known name of its block and the ratio, where that is at least `least`; equal names need no comparing.

    Names that are one letter longer or shorter are looked up. With two letters unmatched no ratio to a name of n letters is above
    n / (n + 1), so a name for which one letter gave more is settled, and only others are compared with all that may be similar.
    """
    names = known.select(F.col(block).alias("_block"), F.col("name").alias("known_name")).distinct()
    exact = new.join(names, (F.col(block) == F.col("_block")) & (F.col("name") == F.col("known_name")), "left").drop("_block")
    rest, names = exact.where("known_name IS NULL").drop("known_name"), names.withColumnRenamed("_block", block)
    best = lambda pairs: pairs.groupBy(block, "name").agg(F.max_by(F.struct("known_name", "ratio"), F.struct("ratio", "known_name")).alias("m")).select(block, "name", "m.*")
    near = best(one_letter_apart(rest, names, block).withColumn("ratio", similarity(F.col("name"), F.col("known_name"))))
    near = near.where((F.col("ratio") >= least) & (F.col("ratio") > F.length("name") / (F.length("name") + 1) + 1e-12))
    far = best(similar_pairs(rest.join(near, [block, "name"], "left_anti"), names, block, least))
    found = rest.join(near.unionByName(far), [block, "name"])
    return exact.where("known_name IS NOT NULL").select(*new.columns, "known_name", F.lit(1.0).alias("ratio")).unionByName(found.select(*new.columns, "known_name", "ratio"))


def moves(visits: DataFrame) -> DataFrame:
    """One row a visit at another location than the person's visit before: from, to, day, both visits' worth, and whether the person had been there."""
    w = Window.partitionBy("person").orderBy("day", "visit")
    here = Window.partitionBy("person", "loc_name").orderBy("day", "visit")  # within the shuffle by person
    rows = visits.withColumns({"from_loc": F.lag("loc_name").over(w), "prior_revenue": F.lag("revenue").over(w), "prior_lines": F.lag("n_lines").over(w), "prior_day": F.lag("day").over(w), "returns": F.row_number().over(here) > 1})
    return rows.where("from_loc <> loc_name").withColumnRenamed("loc_name", "to_loc")


def closeness(a: Column, b: Column) -> Column:
    """Smaller over larger; at most 0.7 counts 0.3, and a missing or zero side 0.5."""
    share = F.least(a, b).cast("double") / F.nullif(F.greatest(a, b), F.lit(0)).cast("double")
    return F.when(a.isNull() | b.isNull() | (a == 0) | (b == 0), 0.5).when(share > 0.7, share).otherwise(0.3)


def steps(value: Column, high: float, low: float, points: tuple[float, float, float], missing: float) -> Column:
    return F.when(value.isNull(), missing).when(value > high, points[0]).when(value > low, points[1]).otherwise(points[2])


def to_100(value: Column, least: float, most: float) -> Column:
    """Linear from 0 at least to 100 at most, clamped."""
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), (value - least) / (most - least) * 100)) if most > least else F.lit(50.0)


def before_and_after(visits: DataFrame, days: int) -> DataFrame:
    """Each move with averages of the person's visits in the days before it and from it on: range frames within the shuffle by person, no join."""
    w = Window.partitionBy("person").orderBy("_d")
    frames = {"pre": w.rangeBetween(-days, -1), "post": w.rangeBetween(0, days)}
    mean = lambda c, f: kpi.ratio(F.sum(c).over(f), F.count(c).over(f), kpi.NULL)
    v = visits.withColumn("_d", F.datediff("day", F.lit("1970-01-01").cast("date")).cast("long"))
    v = v.withColumns({f"{k}_{n}": mean(c, f) for k, f in frames.items() for n, c in (("revenue", "revenue"), ("lines", "n_lines"))})
    return moves(v).drop("_d")


def _raw_names(spark, sf_dir) -> DataFrame:
    p = facts.places(spark, sf_dir)
    name = F.concat(F.lit("Ann-Marie "), F.translate(F.regexp_extract("stylist_name", r"(\d+)", 1), "0123456789", "abcdefghij"))
    k = F.col("s_suppkey") % 4
    return p.select("stylist_name", "loc_name", F.when(k == 0, F.concat(name, F.lit(" Jr."))).when(k == 1, F.concat(name, F.lit(" (PT)"))).when(k == 2, F.concat(F.lit("  "), F.upper(name), F.lit("  Mgr "))).otherwise(name).alias("raw"))


def name_normalize(spark, sf_dir):
    return _raw_names(spark, sf_dir).select("stylist_name", parsing.person(F.col("raw")).alias("name"))


def stable_ids(spark, sf_dir):
    first = facts.stylist_weeks(spark, sf_dir).groupBy("stylist_name").agg(F.date_format(F.min("week_ending"), "yyyy-MM-dd").alias("first_seen"))
    rows = _raw_names(spark, sf_dir).withColumn("name", parsing.person(F.col("raw"))).join(first, "stylist_name")
    return rows.select("stylist_name", "first_seen", parsing.stable_id(F.lower("loc_name"), F.col("name"), F.col("first_seen")).alias("stylist_id"))


def fuzzy_match(spark, sf_dir):
    """Mistyped names (one letter doubled) against the known ones of their location."""
    known = _raw_names(spark, sf_dir).select("loc_name", parsing.person(F.col("raw")).alias("name"), "stylist_name")
    typed = known.select("loc_name", "stylist_name", F.concat(F.substring("name", 1, 4), F.substring("name", 4, 40)).alias("name"))
    return best_match(typed, known, "loc_name")


def tenure_weeks(spark, sf_dir):
    rows = facts.stylist_weeks(spark, sf_dir).groupBy("stylist_name").agg(F.min("week_ending").alias("first_week"), F.max("week_ending").alias("last_week"), F.count("*").alias("weeks_worked"))
    return rows.withColumn("tenure_weeks", F.greatest(F.lit(0), F.floor(F.datediff("last_week", "first_week") / 7)).cast("long"))


def transfer_edges(spark, sf_dir):
    m = moves(facts.visits(spark, sf_dir))
    return m.select("person", "visit", "day", "from_loc", "to_loc", F.datediff("day", "prior_day").cast("long").alias("gap_days"), F.when(F.col("returns"), "return_transfer").otherwise("transfer").alias("kind"))


def transfer_confidence_factors(spark, sf_dir):
    """Four stepped factors of each move: name (known), performance, overlap, and volume."""
    m = moves(facts.visits(spark, sf_dir))
    like = (closeness(F.col("prior_revenue"), F.col("revenue")) + closeness(F.col("prior_lines"), F.col("n_lines"))) / 2
    volume = closeness(F.col("prior_lines"), F.col("n_lines")) * 0.4 + closeness(F.col("prior_revenue"), F.col("revenue")) * 0.6
    m = m.withColumns({"performance": like, "volume": volume, "overlap": F.datediff("day", "prior_day") < 14})
    score = F.lit(0.30) + steps(F.col("performance"), 0.70, 0.50, (0.25, 0.15, 0.05), 0.10) + F.when(F.col("overlap"), 0.02).otherwise(0.20) + steps(F.col("volume"), 0.80, 0.60, (0.25, 0.15, 0.05), 0.10)
    return m.select("person", "visit", "performance", "volume", "overlap", F.round(score, 6).alias("score"), (F.round(score, 6) < 0.80).alias("needs_confirmation"))


def transfer_impact_prepost(spark, sf_dir):
    out = before_and_after(facts.visits(spark, sf_dir), 12 * 7).where("pre_revenue IS NOT NULL")
    change = lambda c: kpi.ratio(F.col(f"post_{c}") - F.col(f"pre_{c}"), F.col(f"pre_{c}"), kpi.NULL)
    out = out.withColumns({"revenue_change": change("revenue"), "lines_change": change("lines")})
    label = F.when((F.col("revenue_change") >= 0.10) & (F.col("lines_change") >= 0.05), "positive").when((F.col("revenue_change") <= -0.10) & (F.col("lines_change") <= -0.05), "negative").otherwise("mixed")
    return out.select("person", "visit", "from_loc", "to_loc", "pre_revenue", "post_revenue", "pre_lines", "post_lines", "revenue_change", "lines_change", label.alias("impact"))


def talent_flow(spark, sf_dir):
    m = moves(facts.visits(spark, sf_dir))
    ends = m.select(F.inline(F.array(F.struct(F.col("to_loc").alias("loc_name"), F.lit(1).alias("i"), F.lit(0).alias("o")), F.struct(F.col("from_loc").alias("loc_name"), F.lit(0).alias("i"), F.lit(1).alias("o")))))
    out = ends.groupBy("loc_name").agg(F.sum("i").alias("moves_in"), F.sum("o").alias("moves_out")).withColumn("net", F.col("moves_in") - F.col("moves_out"))
    return out.withColumn("kind", F.when(F.col("net") >= FLOW, "destination").when(F.col("net") <= -FLOW, "source").otherwise("balanced"))


def transfer_matrix(spark, sf_dir):
    """Every pair of locations with a move, and its share of the moves out of the first."""
    n = moves(facts.visits(spark, sf_dir)).groupBy("from_loc", "to_loc").agg(F.count("*").alias("n"))
    return n.withColumn("share", kpi.ratio(F.col("n"), F.sum("n").over(Window.partitionBy("from_loc"))))


def transfer_pairs(spark, sf_dir):
    """Moves of every pair of locations."""
    return moves(facts.visits(spark, sf_dir)).groupBy("from_loc", "to_loc").agg(F.count("*").alias("n"))


def career_paths(spark, sf_dir):
    """Whole paths of at least two locations, and how many people took each."""
    return shared_paths(facts.visits(spark, sf_dir), 1)


def shared_paths(visits: DataFrame, people: int = 3, places: int = 2) -> DataFrame:
    """(path, n_people): whole paths of at least `places` stays that at least `people` took."""
    p = paths(visits).where(F.size(F.split("path", " > ")) >= places)
    return p.groupBy("path").agg(F.count("*").alias("n_people")).where(F.col("n_people") >= people)


def paths(visits: DataFrame) -> DataFrame:
    """(person, path): the whole sequence of a person's locations, in order."""
    w = Window.partitionBy("person").orderBy("day", "visit")
    v = visits.withColumn("before", F.lag("loc_name").over(w)).where("before IS NULL OR before <> loc_name")
    return v.groupBy("person").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("day", "visit", "loc_name"))), lambda x: x["loc_name"]), " > ").alias("path"))


def career_paths_whole(spark, sf_dir):
    """Whole paths, those of one location too, that at least two people share."""
    return shared_paths(facts.visits(spark, sf_dir), 2, 1)


def location_effect_score(spark, sf_dir):
    """0 to 100 from what moves to a location change, and how many of its newcomers visit it last."""
    v = facts.visits(spark, sf_dir)
    last = v.groupBy("person").agg(F.max_by("loc_name", F.struct("day", "visit")).alias("last_loc"))
    m = moves(v).join(last, "person").withColumns({"r": F.try_divide((F.col("revenue") - F.col("prior_revenue")).cast("double"), F.col("prior_revenue").cast("double")), "n": F.try_divide((F.col("n_lines") - F.col("prior_lines")).cast("double"), F.col("prior_lines").cast("double"))})
    out = m.groupBy(F.col("to_loc").alias("loc_name")).agg(F.count("*").alias("n_moves"), F.round(F.avg("r"), 6).alias("ticket_effect"), F.round(F.avg("n"), 6).alias("guest_effect"), kpi.ratio(F.count_if(F.col("last_loc") == F.col("to_loc")), F.count("*")).alias("retention"))
    score = to_100(F.col("ticket_effect"), -0.2, 0.2) * 0.25 + to_100(F.col("guest_effect"), -0.2, 0.2) * 0.25 + 50.0 * 0.25 + F.col("retention") * 100 * 0.25
    out = out.withColumn("effect_score", F.floor(score + 0.5).cast("long"))
    return out.withColumn("tier", F.when(F.col("effect_score") >= 70, "accelerator").when(F.col("effect_score") >= 50, "positive").when(F.col("effect_score") >= 30, "neutral").otherwise("drain"))


def event_log_final_state(spark, sf_dir):
    """Events as a versioned log: an error withdraws the user's event before it; the last event that stands decides."""
    from tallyloom.sources.tables import parquet

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = parquet(spark, sf_dir, "events").withColumns({"version": F.row_number().over(w), "next_type": F.lead("event_type").over(w)})
    stands = e.where("event_type <> 'error' AND coalesce(next_type, '') <> 'error'")
    out = stands.groupBy("user_id").agg(F.count("*").alias("n_active"), F.max_by(F.struct("event_id", "event_type", "version"), F.struct("ts", "event_id")).alias("last"))
    return out.select("user_id", "n_active", "last.event_id", "last.event_type", F.col("last.version").cast("long").alias("version"))


def confirmed_moves(spark, sf_dir):
    """Grace period: a move counts once the person's next visit is at the new location too."""
    w = Window.partitionBy("person").orderBy("day", "visit")
    v = facts.visits(spark, sf_dir).withColumns({"before": F.lag("loc_name").over(w), "next_loc": F.lead("loc_name").over(w), "next_day": F.lead("day").over(w)})
    out = v.where("before <> loc_name").withColumn("state", F.when(F.col("next_loc").isNull(), "pending").when(F.col("next_loc") == F.col("loc_name"), "confirmed").otherwise("dropped"))
    return out.select("person", "visit", F.col("before").alias("from_loc"), F.col("loc_name").alias("to_loc"), "state", F.when(F.col("state") == "confirmed", F.col("next_day")).alias("confirmed_on"))


QUERIES = {f.__name__: f for f in (name_normalize, stable_ids, fuzzy_match, tenure_weeks, transfer_edges, transfer_confidence_factors, transfer_impact_prepost, talent_flow, transfer_matrix, transfer_pairs, career_paths, career_paths_whole, location_effect_score, event_log_final_state, confirmed_moves)}

_NAME = "'annmarie ' || translate(regexp_extract(stylist_name, '(\\d+)', 1), '0123456789', 'abcdefghij')"
_MOVES = f"""{facts.VISITS_SQL},
ordered AS (SELECT *, lag(loc_name) OVER w AS from_loc, lag(revenue) OVER w AS prior_revenue, lag(n_lines) OVER w AS prior_lines, lag(day) OVER w AS prior_day, lead(loc_name) OVER w AS next_loc, lead(day) OVER w AS next_day,
  row_number() OVER (PARTITION BY person, loc_name ORDER BY day, visit) > 1 AS returns FROM visits WINDOW w AS (PARTITION BY person ORDER BY day, visit)),
moves AS (SELECT * EXCLUDE (loc_name), loc_name AS to_loc FROM ordered WHERE from_loc <> loc_name)"""
_CLOSE = "(CASE WHEN {a} IS NULL OR {b} IS NULL OR {a} = 0 OR {b} = 0 THEN 0.5::DOUBLE WHEN least({a}, {b})::DOUBLE / greatest({a}, {b})::DOUBLE > 0.7::DOUBLE THEN least({a}, {b})::DOUBLE / greatest({a}, {b})::DOUBLE ELSE 0.3::DOUBLE END)"
_CR, _CN = _CLOSE.format(a="prior_revenue", b="revenue"), _CLOSE.format(a="prior_lines", b="n_lines")
_100 = "least(100.0::DOUBLE, greatest(0.0::DOUBLE, ({v} - -0.2::DOUBLE) / (0.2::DOUBLE - -0.2::DOUBLE) * 100))"
ORACLE = {
    "name_normalize": f"SELECT s_name AS stylist_name, {_NAME.replace('stylist_name', 's_name')} AS name FROM supplier",
    "stable_ids": f"""WITH {facts.LINES_SQL}, f AS (SELECT stylist_name, loc_name, min(week_ending)::VARCHAR AS first_seen, {_NAME} AS name FROM lines GROUP BY stylist_name, loc_name)
SELECT stylist_name, first_seen, lower(loc_name) || '_' || substr(replace(name, ' ', '_'), 1, 20) || '_' || substr(sha256(lower(loc_name) || '|' || name || '|' || first_seen), 1, 8) AS stylist_id FROM f""",
    "fuzzy_match": f"""WITH {facts.LINES_SQL}, n AS (SELECT loc_name, stylist_name, {_NAME} AS k FROM places)
SELECT loc_name, stylist_name, substr(k, 1, 4) || substr(k, 4) AS name, k AS known_name, 2.0::DOUBLE * length(k) / (2 * length(k) + 1) AS ratio FROM n""",
    "tenure_weeks": f"WITH {facts.LINES_SQL} SELECT stylist_name, min(week_ending) AS first_week, max(week_ending) AS last_week, count(DISTINCT week_ending) AS weeks_worked, ((max(week_ending) - min(week_ending)) // 7)::BIGINT AS tenure_weeks FROM lines GROUP BY 1",
    "transfer_edges": f"WITH {_MOVES} SELECT person, visit, day, from_loc, to_loc, day - prior_day AS gap_days, CASE WHEN returns THEN 'return_transfer' ELSE 'transfer' END AS kind FROM moves",
    "transfer_confidence_factors": f"""WITH {_MOVES}, f AS (SELECT person, visit, ({_CR} + {_CN}) / 2 AS performance, {_CN} * 0.4::DOUBLE + {_CR} * 0.6::DOUBLE AS volume, day - prior_day < 14 AS overlap FROM moves),
s AS (SELECT *, round(0.3::DOUBLE + CASE WHEN performance > 0.7::DOUBLE THEN 0.25::DOUBLE WHEN performance > 0.5 THEN 0.15::DOUBLE ELSE 0.05::DOUBLE END + CASE WHEN overlap THEN 0.02::DOUBLE ELSE 0.2::DOUBLE END + CASE WHEN volume > 0.8::DOUBLE THEN 0.25::DOUBLE WHEN volume > 0.6::DOUBLE THEN 0.15::DOUBLE ELSE 0.05::DOUBLE END, 6) AS score FROM f)
SELECT *, score < 0.8::DOUBLE AS needs_confirmation FROM s""",
    "transfer_impact_prepost": f"""WITH {_MOVES}, b AS (SELECT m.person, m.visit, m.from_loc, m.to_loc, (sum(v.revenue) FILTER (v.day < m.day))::DOUBLE / count(*) FILTER (v.day < m.day) AS pre_revenue, (sum(v.revenue) FILTER (v.day >= m.day))::DOUBLE / count(*) FILTER (v.day >= m.day) AS post_revenue,
  (sum(v.n_lines) FILTER (v.day < m.day))::DOUBLE / count(*) FILTER (v.day < m.day) AS pre_lines, (sum(v.n_lines) FILTER (v.day >= m.day))::DOUBLE / count(*) FILTER (v.day >= m.day) AS post_lines
  FROM moves m JOIN visits v ON m.person = v.person AND v.day BETWEEN m.day - 84 AND m.day + 84 GROUP BY ALL HAVING count(*) FILTER (v.day < m.day) > 0),
c AS (SELECT *, (post_revenue - pre_revenue) / nullif(pre_revenue, 0) AS revenue_change, (post_lines - pre_lines) / nullif(pre_lines, 0) AS lines_change FROM b)
SELECT *, CASE WHEN revenue_change >= 0.1::DOUBLE AND lines_change >= 0.05::DOUBLE THEN 'positive' WHEN revenue_change <= -0.1::DOUBLE AND lines_change <= -0.05::DOUBLE THEN 'negative' ELSE 'mixed' END AS impact FROM c""",
    "talent_flow": f"""WITH {_MOVES}, e AS (SELECT to_loc AS loc_name, 1 AS i, 0 AS o FROM moves UNION ALL SELECT from_loc, 0, 1 FROM moves), t AS (SELECT loc_name, sum(i)::BIGINT AS moves_in, sum(o)::BIGINT AS moves_out, (sum(i) - sum(o))::BIGINT AS net FROM e GROUP BY 1)
SELECT *, CASE WHEN net >= {FLOW} THEN 'destination' WHEN net <= -{FLOW} THEN 'source' ELSE 'balanced' END AS kind FROM t""",
    "transfer_matrix": f"WITH {_MOVES}, n AS (SELECT from_loc, to_loc, count(*) AS n FROM moves GROUP BY 1, 2) SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY from_loc) AS share FROM n",
    "transfer_pairs": f"WITH {_MOVES} SELECT from_loc, to_loc, count(*) AS n FROM moves GROUP BY 1, 2",
    "career_paths": f"""WITH {_MOVES}, p AS (SELECT person, string_agg(loc_name, ' > ' ORDER BY day, visit) AS path FROM ordered WHERE from_loc IS NULL OR from_loc <> loc_name GROUP BY 1 HAVING count(*) >= 2)
SELECT path, count(*) AS n_people FROM p GROUP BY 1""",
    "career_paths_whole": f"""WITH {_MOVES}, p AS (SELECT person, string_agg(loc_name, ' > ' ORDER BY day, visit) AS path FROM ordered WHERE from_loc IS NULL OR from_loc <> loc_name GROUP BY 1)
SELECT path, count(*) AS n_people FROM p GROUP BY 1 HAVING count(*) >= 2""",
    "location_effect_score": f"""WITH {_MOVES}, l AS (SELECT person, arg_max(loc_name, (day, visit)) AS last_loc FROM visits GROUP BY 1),
t AS (SELECT to_loc AS loc_name, count(*) AS n_moves, round(avg((revenue - prior_revenue)::DOUBLE / nullif(prior_revenue::DOUBLE, 0)), 6) AS ticket_effect, round(avg((n_lines - prior_lines)::DOUBLE / nullif(prior_lines::DOUBLE, 0)), 6) AS guest_effect, count(*) FILTER (last_loc = to_loc)::DOUBLE / count(*) AS retention FROM moves JOIN l USING (person) GROUP BY 1),
s AS (SELECT *, floor({_100.format(v='ticket_effect')} * 0.25 + {_100.format(v='guest_effect')} * 0.25 + 12.5 + retention * 100 * 0.25 + 0.5)::BIGINT AS effect_score FROM t)
SELECT *, CASE WHEN effect_score >= 70 THEN 'accelerator' WHEN effect_score >= 50 THEN 'positive' WHEN effect_score >= 30 THEN 'neutral' ELSE 'drain' END AS tier FROM s""",
    "event_log_final_state": """WITH v AS (SELECT *, row_number() OVER w AS version, lead(event_type) OVER w AS next_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
a AS (SELECT * FROM v WHERE event_type <> 'error' AND coalesce(next_type, '') <> 'error'), l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k, count(*) OVER (PARTITION BY user_id) AS n_active FROM a)
SELECT user_id, n_active, event_id, event_type, version FROM l WHERE k = 1""",
    "confirmed_moves": f"""WITH {_MOVES}, s AS (SELECT person, visit, from_loc, to_loc, CASE WHEN next_loc IS NULL THEN 'pending' WHEN next_loc = to_loc THEN 'confirmed' ELSE 'dropped' END AS state, next_day FROM moves)
SELECT person, visit, from_loc, to_loc, state, CASE WHEN state = 'confirmed' THEN next_day END AS confirmed_on FROM s""",
}
