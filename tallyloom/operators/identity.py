"""Who is who: raw names resolved to stable ids, the master table they come from, and checks that two sources speak of one place.

Names are compared only within a location and only where they share enough groups of letters; names that are similar enough always do, so
nothing is lost by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import parsing
from tallyloom.operators.people import MATCH, best_match, similar_pairs, similarity
from tallyloom.operators.rounds import first_wins
from tallyloom.sources import facts
from tallyloom.sources.work import stored, work_folder

#: Similarity of two location names below which they differ, and below which they are doubtful.
DIFFERENT, DOUBTFUL = 0.70, 0.95


def new_ids(people: DataFrame, taken: DataFrame, block: str, first_seen: str) -> DataFrame:
    """people(block, name, first_seen) with stylist_id; an id that is in taken(stylist_id) gets a longer hash."""
    parts = (F.col(block), F.col("name"), F.col(first_seen))
    rows = people.withColumn("_id", parsing.stable_id(*parts))
    rows = rows.join(taken.select(F.col("stylist_id").alias("_id"), F.lit(True).alias("_taken")).distinct(), "_id", "left")
    return rows.withColumn("stylist_id", F.when(F.col("_taken"), parsing.stable_id(*parts, digits=12)).otherwise(F.col("_id"))).drop("_id", "_taken")


def resolve(people: DataFrame, master: DataFrame, block: str, first_seen: str, least: float = MATCH) -> DataFrame:
    """people(block, raw, first_seen) with name, stylist_id, canonical_name and how they were found: exact, fuzzy or new.

    master(block, stylist_id, canonical_name, normalized_name) holds who is known. A name that equals a known one after normalisation is
    that person; else the most similar known name of the location, if similar enough; else a new id, whose canonical name is the raw one.
    Rows with equal names get equal ids; a null raw name has no letters and is resolved like an empty one.
    """
    rows = people.withColumn("name", parsing.person(F.coalesce("raw", F.lit(""))))
    found = best_match(rows.select(block, "name").distinct(), master.select(block, F.col("normalized_name").alias("name")), block, least)
    known = master.groupBy(F.col(block), F.col("normalized_name").alias("known_name")).agg(F.min_by(F.struct("stylist_id", "canonical_name"), "stylist_id").alias("who"))
    rows = rows.join(found.drop("ratio"), [block, "name"], "left").join(known, [block, "known_name"], "left")
    made = new_ids(rows.where("who IS NULL"), master, block, first_seen).withColumns({"canonical_name": F.col("raw"), "how": F.lit("new")})
    old = rows.where("who IS NOT NULL").select("*", "who.*").withColumn("how", F.when(F.col("known_name") == F.col("name"), "exact").otherwise("fuzzy"))
    return old.select(made.columns).unionByName(made).drop("who", "known_name")


def master_table(rows: DataFrame, block: str, week: str, least: float = MATCH) -> DataFrame:
    """(block, canonical_name, normalized_name, first_seen, stylist_id, variants) from rows(block, raw, week), oldest first.

    A name is a variant of the most similar person seen before it, if similar enough, else a new person. Who is one is settled in rounds
    over the pairs of similar names (see `first_wins`), so no location has to be gone through in one task.
    """
    raws = rows.withColumn("name", parsing.person(F.col("raw"))).where("name <> ''").groupBy(block, "name", "raw").agg(F.min(week).alias("seen"))
    names = raws.groupBy(block, "name").agg(F.min("seen").alias("first_seen"), F.min_by("raw", F.struct("seen", "raw")).alias("canonical_name"))
    pairs = similar_pairs(names.select(block, "name"), names.select(block, F.col("name").alias("known_name")), block, least).where("name <> known_name")
    order = names.select(block, "name", F.col("first_seen").alias("s"), F.col("canonical_name").alias("c"))
    pairs = pairs.join(order, [block, "name"]).join(order.toDF(block, "known_name", "ks", "kc"), [block, "known_name"])
    pairs = pairs.where(F.struct("ks", "kc") < F.struct("s", "c")).select(block, "name", "known_name", "ratio", "s", "c")

    pairs = stored(pairs, work_folder(rows.sparkSession, "names"))
    persons = first_wins(pairs, [block], "known_name").where("is_first").select(block, F.col("name").alias("known_name"))
    merged = pairs.join(persons, [block, "known_name"]).groupBy(block, "name").agg(F.max_by("known_name", F.struct("ratio", "known_name")).alias("person"))
    raws = raws.join(merged, [block, "name"], "left").withColumn("person", F.coalesce("person", "name"))
    persons = names.withColumnRenamed("name", "person")
    every = raws.groupBy(block, "person").agg(F.sort_array(F.collect_set("raw")).alias("raws"))
    out = persons.join(every, [block, "person"])
    out = out.withColumns({"name": F.col("person"), "stylist_id": parsing.stable_id(F.col(block), F.col("person"), F.col("first_seen")), "normalized_name": F.col("person")})
    return out.select(block, "canonical_name", "normalized_name", "first_seen", "stylist_id", F.array_remove("raws", F.col("canonical_name")).alias("variants"))


def same_place(ratio: Column) -> Column:
    """What a similarity of two sources' location names means."""
    return F.when(ratio < DIFFERENT, "fail").when(ratio < DOUBTFUL, "warn").otherwise("pass")


def merge_ids(rows: DataFrame, merges: DataFrame, key: str) -> DataFrame:
    """rows with key replaced by the id that merges(secondary, primary) gives it; ids without one stay."""
    m = merges.groupBy(F.col("secondary").alias(key)).agg(F.min("primary").alias("_to"))
    return rows.join(m, key, "left").withColumn(key, F.coalesce("_to", key)).drop("_to")


def _people(spark, sf_dir) -> DataFrame:
    """Suppliers under made-up names of two words."""
    h = F.translate(F.md5(F.col("stylist_name").cast("binary")), "0123456789", "ghijklmnop")
    return facts.places(spark, sf_dir).select("s_suppkey", "stylist_name", F.lower("loc_name").alias("place"), F.concat_ws(" ", F.substring(h, 1, 6), F.substring(h, 7, 8)).alias("base"))


def _typed(base: Column) -> Column:
    """The fourth letter twice."""
    return F.concat(F.substring(base, 1, 4), F.substring(base, 4, 40))


def _resolved(spark, sf_dir) -> DataFrame:
    p = _people(spark, sf_dir)
    seen = F.lit("2020-01-05")
    master = p.where("s_suppkey % 3 <> 0").select("place", parsing.stable_id(F.col("place"), F.col("base"), seen).alias("stylist_id"), F.initcap("base").alias("canonical_name"), F.col("base").alias("normalized_name"))
    k = F.col("s_suppkey") % 4
    raw = F.when(k == 0, F.concat(F.upper("base"), F.lit(" Jr."))).when(k == 1, _typed(F.col("base"))).when(k == 2, F.concat(F.lit("(PT)  "), F.col("base"))).otherwise(F.concat(F.col("base"), F.lit(" III lead")))
    return resolve(p.select("stylist_name", "place", raw.alias("raw"), F.lit("2024-01-07").alias("first_seen")), master, "place", "first_seen")


def resolve_identity(spark, sf_dir):
    """A batch of names in four spellings, one mistyped, against a master that lacks every third person."""
    return _resolved(spark, sf_dir).select("stylist_name", "stylist_id", "canonical_name", "how")


def resolve_batch(spark, sf_dir):
    """What a batch brings to each location: how its names were resolved."""
    n = lambda how: F.count_if(F.col("how") == how).alias(f"n_{how}")
    return _resolved(spark, sf_dir).groupBy("place").agg(F.count("*").alias("n"), n("exact"), n("fuzzy"), n("new"), F.count_distinct("stylist_id").alias("n_ids"))


def longer_ids_on_collision(spark, sf_dir):
    """Persons whose id is taken already, every other one, get twelve digits."""
    p = _people(spark, sf_dir).select("s_suppkey", "place", F.col("base").alias("name"), F.lit("2020-01-05").alias("seen"))
    taken = p.where("s_suppkey % 2 = 0").select(parsing.stable_id(F.col("place"), F.col("name"), F.col("seen")).alias("stylist_id"))
    return new_ids(p, taken, "place", "seen").select("s_suppkey", "stylist_id")


def master_backfill(spark, sf_dir):
    """Weekly rows whose names are spelt in three ways; the master has each person once, with the other spellings."""
    weeks = facts.stylist_weeks(spark, sf_dir).select("stylist_name", F.date_format("week_ending", "yyyy-MM-dd").alias("week"), F.month("week_ending").alias("m"))
    k = F.col("m") % 3
    raw = F.when(k == 0, F.col("base")).when(k == 1, F.concat(F.upper("base"), F.lit(" Jr"))).otherwise(_typed(F.col("base")))
    rows = weeks.join(_people(spark, sf_dir), "stylist_name").select("place", raw.alias("raw"), "week")
    return master_table(rows, "place", "week").select("place", "canonical_name", "first_seen", "stylist_id", F.array_join("variants", "; ").alias("variants"))


def location_name_check(spark, sf_dir):
    """Names of one place in two sources: equal, with a remark behind, or of another place."""
    p = facts.places(spark, sf_dir).select("loc_name", "loc_id").distinct()
    other = F.when(F.col("loc_id") % 3 == 0, F.col("loc_name")).when(F.col("loc_id") % 3 == 1, F.concat("loc_name", F.lit(" FS"))).otherwise("zzzzzz")
    out = p.withColumn("similarity", similarity(F.lower(F.trim("loc_name")), F.lower(other)))
    return out.select("loc_name", "similarity", same_place(F.col("similarity")).alias("status"))


def system_match(spark, sf_dir):
    """Both sources of a location-week must be of one system; every seventh pair is not."""
    rows = facts.location_weeks(spark, sf_dir).select("loc_name", "week_ending", "platform", F.when(F.dayofyear("week_ending") % 7 == 0, "other").otherwise(F.col("platform")).alias("paired"))
    return rows.select("loc_name", "week_ending", F.when(F.col("platform").eqNullSafe(F.col("paired")), "pass").otherwise("fail").alias("status"))


def merged_ids(spark, sf_dir):
    """History of persons whose second id was merged into the first: odd ids into the even one before them."""
    p = facts.places(spark, sf_dir).select("stylist_name", "s_suppkey")
    first = p.select(F.col("stylist_name").alias("primary"), (F.col("s_suppkey") + 1).alias("s_suppkey"))
    merges = p.where("s_suppkey % 2 = 1").join(first, "s_suppkey").select(F.col("stylist_name").alias("secondary"), "primary")
    rows = merge_ids(facts.stylist_weeks(spark, sf_dir).select("stylist_name", "week_ending", "guests"), merges, "stylist_name")
    return rows.groupBy("stylist_name").agg(F.count_distinct("week_ending").alias("n_weeks"), F.sum("guests").alias("guests"))


QUERIES = {f.__name__: f for f in (resolve_identity, resolve_batch, longer_ids_on_collision, master_backfill, location_name_check, system_match, merged_ids)}

_PEOPLE = """people AS (SELECT s_suppkey, stylist_name, lower(loc_name) AS place, translate(md5(stylist_name), '0123456789', 'ghijklmnop') AS h,
  substr(translate(md5(stylist_name), '0123456789', 'ghijklmnop'), 1, 6) || ' ' || substr(translate(md5(stylist_name), '0123456789', 'ghijklmnop'), 7, 8) AS base FROM places)"""
_TYPED = "substr(base, 1, 4) || substr(base, 4)"


def _id(name: str, seen: str, digits: int = 8) -> str:
    return f"place || '_' || substr(replace({name}, ' ', '_'), 1, 20) || '_' || substr(sha256(place || '|' || {name} || '|' || {seen}), 1, {digits})"


_RESOLVED = f"""{facts.LINES_SQL}, {_PEOPLE},
n AS (SELECT *, CASE WHEN s_suppkey % 4 = 1 THEN {_TYPED} ELSE base END AS name,
  CASE s_suppkey % 4 WHEN 0 THEN upper(base) || ' Jr.' WHEN 1 THEN {_TYPED} WHEN 2 THEN '(PT)  ' || base ELSE base || ' III lead' END AS raw, s_suppkey % 3 <> 0 AS known FROM people),
r AS (SELECT stylist_name, place, CASE WHEN known THEN {_id("base", "'2020-01-05'")} ELSE {_id("name", "'2024-01-07'")} END AS stylist_id,
  CASE WHEN known THEN upper(substr(base, 1, 1)) || substr(base, 2, 6) || upper(substr(base, 8, 1)) || substr(base, 9) ELSE raw END AS canonical_name,
  CASE WHEN NOT known THEN 'new' WHEN s_suppkey % 4 = 1 THEN 'fuzzy' ELSE 'exact' END AS how FROM n)"""
ORACLE = {
    "resolve_identity": f"WITH {_RESOLVED} SELECT stylist_name, stylist_id, canonical_name, how FROM r",
    "resolve_batch": f"""WITH {_RESOLVED} SELECT place, count(*) AS n, count(*) FILTER (how = 'exact') AS n_exact, count(*) FILTER (how = 'fuzzy') AS n_fuzzy,
  count(*) FILTER (how = 'new') AS n_new, count(DISTINCT stylist_id) AS n_ids FROM r GROUP BY 1""",
    "longer_ids_on_collision": f"""WITH {facts.LINES_SQL}, {_PEOPLE}
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN {_id("base", "'2020-01-05'", 12)} ELSE {_id("base", "'2020-01-05'")} END AS stylist_id FROM people""",
    "master_backfill": f"""WITH {facts.LINES_SQL}, {_PEOPLE},
w AS (SELECT DISTINCT place, base, week_ending::VARCHAR AS week, CASE month(week_ending) % 3 WHEN 0 THEN base WHEN 1 THEN upper(base) || ' Jr' ELSE {_TYPED} END AS raw,
  CASE WHEN month(week_ending) % 3 = 2 THEN {_TYPED} ELSE base END AS name FROM lines JOIN people USING (stylist_name)),
f AS (SELECT place, base, raw, name, min(week) AS seen FROM w GROUP BY ALL),
c AS (SELECT place, base, arg_min(raw, (seen, raw)) AS canonical_name, arg_min(name, (seen, raw)) AS name, min(seen) AS first_seen FROM f GROUP BY ALL)
SELECT place, canonical_name, first_seen, {_id("c.name", "first_seen")} AS stylist_id,
  coalesce((SELECT string_agg(raw, '; ' ORDER BY raw) FROM f WHERE f.place = c.place AND f.base = c.base AND raw <> canonical_name), '') AS variants FROM c""",
    "location_name_check": f"""WITH {facts.LINES_SQL}, p AS (SELECT DISTINCT loc_name, loc_id, length(loc_name) AS n FROM places),
s AS (SELECT loc_name, CASE loc_id % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE * n / (2 * n + 3) ELSE 0.0::DOUBLE END AS similarity FROM p)
SELECT *, CASE WHEN similarity < 0.7::DOUBLE THEN 'fail' WHEN similarity < 0.95::DOUBLE THEN 'warn' ELSE 'pass' END AS status FROM s""",
    "system_match": f"WITH {facts.WEEKS_SQL} SELECT loc_name, week_ending, CASE WHEN dayofyear(week_ending) % 7 = 0 THEN 'fail' ELSE 'pass' END AS status FROM lw",
    "merged_ids": f"""WITH {facts.STYLISTS_SQL}, k AS (SELECT sw.*, s_suppkey FROM sw JOIN places USING (stylist_name)),
m AS (SELECT k.*, coalesce(p.stylist_name, k.stylist_name) AS who FROM k LEFT JOIN places p ON k.s_suppkey % 2 = 1 AND p.s_suppkey = k.s_suppkey - 1)
SELECT who AS stylist_name, count(DISTINCT week_ending) AS n_weeks, sum(guests)::BIGINT AS guests FROM m GROUP BY 1""",
}
