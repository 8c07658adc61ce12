"""Idempotent tables: keyed appends, upserts, patches, roster-ordered overwrites, and the merge of two sources.

Appends are deduplicated within the batch (the first row of a key wins) and against the table, so running one twice adds nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions import kpi
from tallyloom.sources import facts
from tallyloom.sources.work import stored, work_folder

WEEK = "week_ending"


def first_of(df: DataFrame, keys: list[str], *order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def new_rows(existing: DataFrame, incoming: DataFrame, keys: list[str], *order) -> DataFrame:
    """incoming's first row of each key that existing lacks."""
    return first_of(incoming, keys, *order).join(existing.select(*keys).distinct(), keys, "left_anti")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of existing whose key isn't in new, and all of new."""
    return existing.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def patch(base: DataFrame, patches: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """base with columns replaced where patches(keys, columns) has a value that isn't null; keys must be unique there."""
    p = patches.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns))
    return base.join(p, keys, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in columns}).drop(*(f"_{c}" for c in columns))


def roster_merge(existing: DataFrame, fresh: DataFrame, roster: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """A row for everyone on roster(key, ordinal): fresh figures, else existing ones, else null."""
    e, f = (d.select(key, *(F.col(c).alias(f"{p}{c}") for c in columns), F.lit(True).alias(f"{p}has")) for d, p in ((existing, "e_"), (fresh, "f_")))
    out = roster.join(e, key, "left").join(f, key, "left")
    pick = {c: F.when(F.col("f_has"), F.col(f"f_{c}")).otherwise(F.col(f"e_{c}")) for c in columns}
    origin = F.when(F.col("f_has"), "fresh").when(F.col("e_has"), "kept").otherwise("blank")
    return out.select(key, "ordinal", *(v.alias(c) for c, v in pick.items()), origin.alias("origin"))


def overlap_action(share: Column) -> Column:
    """What to do with a batch by the share of its keys already stored."""
    return F.when(share == 0, "PROCEED").when(share < 0.2, "WARN").when(share < 0.5, "CONFIRM").otherwise("BLOCK")


def fingerprint(keys: Column) -> Column:
    """Aggregate: SHA-256 of the sorted keys, one to a line."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(keys)), "\n"), 256)


def append_ledger(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], *order) -> dict[str, int]:
    """Appends new keys to the Parquet ledger at path and says how many rows came, were repeated in the batch, were stored already, and are new.

    The batch is computed once, into a staged table that is removed in the end; a run that fails before the append has added nothing, and
    run again it adds each key once.
    """
    staged = f"{path.rstrip('/')}__staged/{uuid.uuid4().hex}"
    came, added = Observation(), Observation()
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = incoming.withColumn("_n", F.row_number().over(w))
    ranked.observe(came, F.count("*").alias("received"), F.count_if(F.col("_n") > 1).alias("repeated")).write.parquet(staged)
    try:
        batch = spark.read.schema(ranked.schema).parquet(staged).where("_n = 1").drop("_n")
        existing = existing_rows(spark, path)
        new = batch if existing is None else batch.join(existing.select(*keys).distinct(), keys, "left_anti").select(batch.columns)
        new.observe(added, F.count("*").alias("appended")).write.mode("append").parquet(path)
    finally:
        remove(spark, staged)
    n = {**came.get, **added.get}
    return {**n, "stored": n["received"] - n["repeated"] - n["appended"]}


def existing_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at path; None if there is none."""
    files, at = _files(spark, path)
    return spark.read.parquet(path) if files.exists(at) else None


def remove(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def overwrite_snapshot(df: DataFrame, path: str, by: str | None = None) -> None:
    """Replaces the table at path, or with `by` only the partitions that df has."""
    w = df.write.mode("overwrite")
    if by:
        w = w.partitionBy(by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def distribute(people: DataFrame, places: DataFrame, key: str, weight: str, amounts: list[str]) -> DataFrame:
    """people with each amount of their place, split by their share of the place's weight; a place with weight 0 gives 0."""
    share = kpi.ratio(F.col(weight), F.sum(weight).over(Window.partitionBy(*key)))
    out = people.withColumn("share", share).join(places.select(*key, *amounts), key, "left")
    return out.withColumns({f"alloc_{a}": F.coalesce(F.col(a).cast("double"), F.lit(0.0)) * F.col("share") for a in amounts})


def for_manager(df: DataFrame, manager: str) -> DataFrame:
    """The manager's rows, or all rows if the manager has none."""
    own = df.select(F.max(F.when(F.col("manager") == manager, 1).otherwise(0)).alias("any"))
    return df.where((F.col("manager") == manager) | (F.coalesce(own.scalar(), F.lit(0)) == 0))


CUT, SEEN = "1998-01", "1998-03"


def _months(spark, sf_dir):
    return kpi.with_ratios(facts.location_months(spark, sf_dir)).select("loc_name", "manager", "platform", "year_month", "guests", "total_sales")


def dedup_keep_first(spark, sf_dir):
    """The first visit of each person to each location."""
    return kpi.plain(first_of(facts.visits(spark, sf_dir), ["person", "loc_name"], "day", "visit"), ["person", "loc_name", "visit", "day", "revenue"])


def append_new_keys(spark, sf_dir):
    """Months up to SEEN are stored; a batch of all months from CUT on, each twice, arrives."""
    m = _months(spark, sf_dir)
    batch = m.where(F.col("year_month") >= CUT)
    out = new_rows(m.where(F.col("year_month") <= SEEN), batch.unionByName(batch.withColumn("guests", F.col("guests") + 1)), ["loc_name", "year_month"], "guests")
    return kpi.plain(out, ["loc_name", "year_month", "guests", "total_sales"])


def upsert_replace_keys(spark, sf_dir):
    m = _months(spark, sf_dir)
    new = m.where((F.col("year_month") >= CUT) & (F.col("platform") == "zenoti")).withColumn("guests", -F.col("guests"))
    return kpi.plain(upsert(m.where(F.col("year_month") <= SEEN), new, ["loc_name", "year_month"]), ["loc_name", "year_month", "guests", "total_sales"])


def patch_by_key(spark, sf_dir):
    """Guests of the platform's later months are patched; a null patch leaves the value."""
    m = _months(spark, sf_dir)
    p = m.where((F.col("year_month") >= CUT) & (F.col("platform") == "salon_ultimate")).select("loc_name", "year_month", F.when(F.col("guests") % 2 == 0, F.col("guests") * 10).alias("guests"))
    return kpi.plain(patch(m, p, ["loc_name", "year_month"], ["guests"]), ["loc_name", "year_month", "guests", "total_sales"])


def roster_merge_overwrite(spark, sf_dir):
    """Every location of the roster in its order: SEEN's figures for one platform, CUT's for the others, blank for locations ending in 3."""
    m = _months(spark, sf_dir)
    roster = facts.places(spark, sf_dir).groupBy("loc_name").agg(F.min("loc_id").cast("long").alias("ordinal"))
    fresh = m.where((F.col("year_month") == SEEN) & (F.col("platform") == "zenoti") & ~F.col("loc_name").endswith("3"))
    old = m.where((F.col("year_month") == CUT) & ~F.col("loc_name").endswith("3"))
    return kpi.plain(roster_merge(old, fresh, roster, "loc_name", ["guests", "total_sales"]), ["loc_name", "ordinal", "guests", "total_sales", "origin"])


def duplicate_overlap(spark, sf_dir):
    """Stylist-weeks of each month as a batch against what is stored: weeks up to the 15th."""
    rows = facts.stylist_weeks(spark, sf_dir).select("stylist_name", "loc_name", WEEK, "year_month", F.when(F.dayofmonth(WEEK) <= F.col("guests") + 8, 1).otherwise(0).alias("stored"))
    out = rows.groupBy("year_month").agg(F.count("*").alias("n_new"), F.sum("stored").alias("n_overlap"))
    out = out.withColumn("share", kpi.ratio(F.col("n_overlap"), F.col("n_new")))
    return out.withColumn("action", overlap_action(F.col("share")))


def batch_fingerprint(spark, sf_dir):
    rows = facts.location_weeks(spark, sf_dir)
    key = F.concat_ws("|", F.lit("LOCATION"), "loc_name", F.date_format(WEEK, "yyyy-MM-dd"))
    return rows.groupBy(WEEK).agg(F.count("*").alias("n_keys"), fingerprint(key).alias("fingerprint"))


def proportional_distribution(spark, sf_dir):
    """A location-month's color and treatment figures, split over its stylists by service."""
    people = facts.totals(facts.lines(spark, sf_dir).withColumn("year_month", facts.year_month(F.col(WEEK))), ["stylist_name", "loc_name", "year_month"]).select("stylist_name", "loc_name", "year_month", "service")
    out = distribute(people, facts.location_months(spark, sf_dir), ["loc_name", "year_month"], "service", ["color", "treat_count"])
    return kpi.plain(out, ["stylist_name", "loc_name", "year_month", "service", "share", "alloc_color", "alloc_treat_count"])


def manager_filter(spark, sf_dir):
    """A manager's months beside those a manager without locations sees: all of them."""
    m = stored(_months(spark, sf_dir), work_folder(spark))
    views = [for_manager(m, who).withColumn("viewer", F.lit(who)) for who in ("REGION_1", "ASIA", "nobody")]
    out = views[0].unionByName(views[1]).unionByName(views[2]).groupBy("viewer").agg(F.count("*").alias("n_rows"), F.count_distinct("loc_name").alias("n_locations"), F.sum("guests").alias("guests"))
    return kpi.plain(out, out.columns)


def schema_map_v2(spark, sf_dir):
    """Location weeks under the newer column names, with period_start six days before the end."""
    rows = kpi.with_ratios(facts.location_weeks(spark, sf_dir))
    out = rows.select(F.col("loc_name").alias("location"), F.date_sub(WEEK, 6).alias("period_start"), F.col(WEEK).alias("period_end"), F.upper("platform").alias("pos_system"), F.col("guests").alias("guest_count"), F.col("total_sales").alias("net_sales"), "product_pct", F.concat_ws("|", F.lit("LOCATION"), "loc_name", F.date_format(WEEK, "yyyy-MM-dd")).alias("row_key"))
    return kpi.plain(out, out.columns)


QUERIES = {f.__name__: f for f in (dedup_keep_first, append_new_keys, upsert_replace_keys, patch_by_key, roster_merge_overwrite, duplicate_overlap, batch_fingerprint, proportional_distribution, manager_filter, schema_map_v2)}

_M = f"{facts.MONTHS_SQL}, m AS (SELECT loc_name, manager, platform, year_month, guests::BIGINT AS guests, (service + product)::DOUBLE AS total_sales FROM lm)"
_COLS = "loc_name, year_month, guests, total_sales"
ORACLE = {
    "dedup_keep_first": f"WITH {facts.VISITS_SQL} SELECT person, loc_name, visit, day, revenue::DOUBLE AS revenue FROM visits QUALIFY row_number() OVER (PARTITION BY person, loc_name ORDER BY day, visit) = 1",
    "append_new_keys": f"WITH {_M} SELECT {_COLS} FROM m WHERE year_month > '{SEEN}' OR (year_month >= '{CUT}' AND NOT EXISTS (SELECT 1 FROM m x WHERE x.year_month <= '{SEEN}' AND x.loc_name = m.loc_name AND x.year_month = m.year_month))",
    "upsert_replace_keys": f"WITH {_M} SELECT {_COLS} FROM m WHERE year_month <= '{SEEN}' AND NOT (year_month >= '{CUT}' AND platform = 'zenoti') UNION ALL SELECT loc_name, year_month, -guests, total_sales FROM m WHERE year_month >= '{CUT}' AND platform = 'zenoti'",
    "patch_by_key": f"WITH {_M} SELECT loc_name, year_month, CASE WHEN year_month >= '{CUT}' AND platform = 'salon_ultimate' AND guests % 2 = 0 THEN guests * 10 ELSE guests END AS guests, total_sales FROM m",
    "roster_merge_overwrite": f"""WITH {_M}, x AS (SELECT *, loc_name LIKE '%3' AS off FROM m),
f AS (SELECT * FROM x WHERE year_month = '{SEEN}' AND platform = 'zenoti' AND NOT off), e AS (SELECT * FROM x WHERE year_month = '{CUT}' AND NOT off)
SELECT r.loc_name, r.ordinal, CASE WHEN f.loc_name IS NOT NULL THEN f.guests ELSE e.guests END AS guests, CASE WHEN f.loc_name IS NOT NULL THEN f.total_sales ELSE e.total_sales END AS total_sales,
  CASE WHEN f.loc_name IS NOT NULL THEN 'fresh' WHEN e.loc_name IS NOT NULL THEN 'kept' ELSE 'blank' END AS origin
FROM (SELECT loc_name, min(loc_id)::BIGINT AS ordinal FROM places GROUP BY 1) r LEFT JOIN f USING (loc_name) LEFT JOIN e ON e.loc_name = r.loc_name""",
    "duplicate_overlap": f"""WITH {facts.STYLISTS_SQL}, o AS (SELECT year_month, count(*) AS n_new, count(*) FILTER (day(week_ending) <= guests + 8) AS n_overlap FROM sw GROUP BY 1)
SELECT *, n_overlap::DOUBLE / n_new AS share, CASE WHEN share = 0 THEN 'PROCEED' WHEN share < 0.2::DOUBLE THEN 'WARN' WHEN share < 0.5 THEN 'CONFIRM' ELSE 'BLOCK' END AS action FROM o""",
    "batch_fingerprint": f"WITH {facts.WEEKS_SQL} SELECT week_ending, count(*) AS n_keys, sha256(string_agg('LOCATION|' || loc_name || '|' || week_ending::VARCHAR, chr(10) ORDER BY 'LOCATION|' || loc_name || '|' || week_ending::VARCHAR)) AS fingerprint FROM lw GROUP BY 1",
    "proportional_distribution": f"""WITH {facts.MONTHS_SQL}, sm AS (SELECT stylist_name, loc_name, strftime(week_ending, '%Y-%m') AS year_month, sum(CASE WHEN p_type <> 'PROMO' THEN net ELSE 0 END) AS service FROM lines GROUP BY ALL),
s AS (SELECT *, coalesce(service::DOUBLE / nullif((sum(service) OVER (PARTITION BY loc_name, year_month))::DOUBLE, 0), 0.0) AS share FROM sm)
SELECT stylist_name, s.loc_name, s.year_month, s.service::DOUBLE AS service, share, color::DOUBLE * share AS alloc_color, treat_count::DOUBLE * share AS alloc_treat_count FROM s JOIN lm USING (loc_name, year_month)""",
    "manager_filter": f"""WITH {_M}, v AS (SELECT unnest(['REGION_1', 'ASIA', 'nobody']) AS viewer)
SELECT viewer, count(*) AS n_rows, count(DISTINCT loc_name) AS n_locations, sum(guests)::BIGINT AS guests FROM v JOIN m ON manager = viewer OR viewer NOT IN (SELECT manager FROM m) GROUP BY 1""",
    "schema_map_v2": f"""WITH {facts.WEEKS_SQL} SELECT loc_name AS location, week_ending - 6 AS period_start, week_ending AS period_end, upper(platform) AS pos_system, guests::BIGINT AS guest_count, (service + product)::DOUBLE AS net_sales, {kpi.ratios_sql(kpi.LOCATION_RATIOS[:1])}, 'LOCATION|' || loc_name || '|' || week_ending::VARCHAR AS row_key FROM lw""",
}
