"""Checks around a batch: headers and their fingerprints, files and what they are, gates, reports of what was found, and what becomes of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import kpi, parsing
from tallyloom.operators import trust
from tallyloom.operators.trust import check
from tallyloom.sources import facts

WEEK = "week_ending"
KEYS = ["loc_name", WEEK]
#: Expected headers by system.
HEADERS = {"zenoti": ("Employee", "Service", "Product", "Hours"), "salon_ultimate": ("Provider Name", "Service Sales", "Retail Sales", "Hours Worked")}


def header_errors(header: Column, expected: Column) -> Column:
    """Places where a header row differs from what is expected, without regard to case and blanks; also where it is too short."""
    n = F.sequence(F.lit(0), F.size(expected) - 1)
    wrong = lambda i: ~F.coalesce(parsing.header(F.get(header, i)) == parsing.header(F.get(expected, i)), F.lit(False))
    return F.filter(n, wrong)


def header_fingerprint(header: Column) -> Column:
    """SHA-256 of the lower-case trimmed labels joined by a pipe."""
    return F.sha2(F.array_join(F.transform(header, lambda x: F.lower(F.trim(x))), "|"), 256)


def fingerprint_status(df: DataFrame, keys: list[str], order: str, fingerprint: str) -> DataFrame:
    """df with status: the first fingerprint of its keys is stored, an equal one passes, another one fails until a person accepts it."""
    w = Window.partitionBy(*keys).orderBy(order)
    first = F.first(fingerprint).over(w)
    return df.withColumn("status", F.when(F.row_number().over(w) == 1, "stored").when(F.col(fingerprint) == first, "pass").otherwise("fail"))


def by_system(system: Column, cases: dict[str, Column]) -> Column:
    """The check of the row's system; an unknown system is a warning of 5."""
    out = None
    for name, c in cases.items():
        out = F.when(system == name, c) if out is None else out.when(system == name, c)
    return out.otherwise(F.struct(F.lit("schema").alias("name"), F.lit("warn").alias("status"), F.lit(5).cast("long").alias("severity")))


def file_kind(path: Column) -> Column:
    """What a file is by its name; null for what is no report."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    return F.when(name.endswith(".xls"), "su_excel").when(name.endswith(".xlsx"), "zenoti_excel").when(name.endswith(".pdf") & name.contains("dashboard"), "su_pdf").when(name.endswith(".pdf"), "zenoti_pdf")


def file_parts(files: DataFrame, path: str = "path") -> DataFrame:
    """files with bucket, week_ending and kind from .../<bucket>/<week>/<file>."""
    p = F.split(path, "/")
    return files.withColumns({"bucket": F.element_at(p, -3), WEEK: F.try_to_date(F.element_at(p, -2)), "file": F.element_at(p, -1), "kind": file_kind(F.col(path))})


def coverage(files: DataFrame, roster: DataFrame, key: str) -> DataFrame:
    """(key, status): ok, missing (on the roster without a file) or unmapped (a file that no one on the roster has)."""
    f, r = files.select(key).distinct().withColumn("_f", F.lit(True)), roster.select(key).distinct().withColumn("_r", F.lit(True))
    return f.join(r, key, "full").select(key, F.when(F.col("_f").isNull(), "missing").when(F.col("_r").isNull(), "unmapped").otherwise("ok").alias("status"))


def open_issues(issues: DataFrame, accepted: DataFrame) -> DataFrame:
    """Errors whose location and code aren't in accepted(code), spelt LOCATION:CODE; warnings never block."""
    return issues.where("severity = 'error'").withColumn("_k", F.concat_ws(":", "loc_name", "code")).join(accepted.select(F.col("code").alias("_k")).distinct(), "_k", "left_anti").drop("_k")


def gate(rows: DataFrame, errors: DataFrame, batch: str) -> DataFrame:
    """The rows of batches without any error: one error keeps a whole batch back."""
    return rows.join(errors.select(batch).distinct(), batch, "left_anti")


def _weeks(spark, sf_dir) -> DataFrame:
    return kpi.with_ratios(facts.location_weeks(spark, sf_dir))


def _headers(spark, sf_dir) -> DataFrame:
    """A header row a location-week: names change in a location's later weeks, one is lost in every ninth week of the year."""
    w = facts.location_weeks(spark, sf_dir).select("loc_name", "platform", WEEK)
    system = F.when(F.dayofyear(WEEK) % 11 == 0, "other").otherwise(F.col("platform"))
    good = F.when(F.col("platform") == "zenoti", F.array(*map(F.lit, HEADERS["zenoti"]))).otherwise(F.array(*map(F.lit, HEADERS["salon_ultimate"])))
    loud = F.transform(good, lambda x: F.concat(F.lit(" "), F.upper(x)))
    late = F.transform(good, lambda x, i: F.when(i == 3, "Time").otherwise(x))
    h = F.when(F.weekofyear(WEEK) % 9 == 0, F.slice(good, 1, 3)).when(F.col(WEEK) >= F.lit("1998-01-01").cast("date"), late).otherwise(loud)
    return w.select("loc_name", WEEK, system.alias("system"), h.alias("header"))


def _schema_check(spark, sf_dir) -> DataFrame:
    c = {s: check("schema", (F.size(header_errors(F.col("header"), F.array(*map(F.lit, names)))) > 0, "fail", 100)) for s, names in HEADERS.items()}
    return _headers(spark, sf_dir).withColumn("c", by_system(F.col("system"), c))


def schema_headers(spark, sf_dir):
    return _schema_check(spark, sf_dir).select(*KEYS, "system", "c.status", "c.severity")


def schema_fingerprints(spark, sf_dir):
    rows = _headers(spark, sf_dir).withColumn("fingerprint", header_fingerprint(F.col("header")))
    return fingerprint_status(rows, ["loc_name"], WEEK, "fingerprint").select(*KEYS, "fingerprint", "status")


def cross_file_totals(spark, sf_dir):
    """Stylists' service and product against their location's sales, of which every thirteenth week states twice as much and every other half."""
    s = facts.stylist_weeks(spark, sf_dir).groupBy(*KEYS).agg(F.sum(F.col("service") + F.col("product")).alias("parts"))
    k = F.weekofyear(WEEK) % 13
    w = _weeks(spark, sf_dir).select(*KEYS, (F.col("total_sales").cast("double") * F.when(k == 0, 4.0).when(k == 1, 0.5).otherwise(1.0)).alias("stated"))
    share = kpi.ratio(F.col("parts"), F.col("stated"), kpi.NULL)
    out = w.join(s, KEYS).withColumn("share", share).withColumn("c", check("cross_file_total", (F.col("share") > 1.10, "fail", 40), (F.col("share") < 0.30, "warn", 15)))
    return out.select(*KEYS, "share", "c.status", "c.severity")


def _validated(spark, sf_dir) -> DataFrame:
    """All checks of a location-week as rows: its header, completeness, and changes against the week before."""
    rows = _schema_check(spark, sf_dir).select(*KEYS, "c.name", "c.status", "c.severity")
    return rows.unionByName(trust.completeness_checks(spark, sf_dir)).unionByName(trust.anomaly_wow(spark, sf_dir).select(*KEYS, "name", "status", "severity"))


def run_validation(spark, sf_dir):
    """The verdict of a location-week over all checks: a failed one rejects it, else its score decides."""
    out = trust.scores(_validated(spark, sf_dir), KEYS)
    return out.select(*KEYS, "score", "n_fail", "n_warn", F.when(F.col("n_fail") > 0, "reject").when(F.col("score") >= 85, "approve").when(F.col("score") >= 70, "review").otherwise("hold").alias("verdict"))


def atomic_gate(spark, sf_dir):
    """Location-weeks of the weeks none of which was rejected."""
    v = run_validation(spark, sf_dir)
    return gate(_weeks(spark, sf_dir).select("loc_name", WEEK, "guests"), v.where("verdict = 'reject'"), WEEK)


def batch_trust(spark, sf_dir):
    """A week's batch: locations by verdict, least and mean score, whether it may be written."""
    v = run_validation(spark, sf_dir)
    n = lambda x: F.count_if(F.col("verdict") == x).alias(f"n_{x}")
    out = v.groupBy(WEEK).agg(F.count("*").alias("n_locations"), n("approve"), n("review"), n("hold"), n("reject"), F.min("score").alias("least"), (F.sum("score") / F.count("*")).alias("mean"))
    return out.withColumn("write", F.col("n_reject") == 0)


def integrity_report(spark, sf_dir):
    """A line for each location of a week, and one for the week."""
    v = run_validation(spark, sf_dir)
    line = F.concat(F.col("loc_name"), F.lit(": "), F.col("score"), F.lit(" "), F.col("verdict"))
    lines = v.groupBy(WEEK).agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("body"), F.min("score").alias("least"))
    return lines.select(WEEK, F.concat_ws("\n", "body", F.concat(F.lit("batch: "), F.col("least"))).alias("report"))


def _files(spark, sf_dir) -> DataFrame:
    """A file a location-week, by name: reports of four kinds, and notes that are none. Every tenth location has no file, one file no location."""
    w = facts.location_weeks(spark, sf_dir).where(~F.col("loc_name").endswith("7")).select("loc_name", "platform", WEEK)
    k = F.dayofyear(WEEK) % 5
    name = F.concat("loc_name", F.when(k == 0, ".xls").when(k == 1, ".xlsx").when(k == 2, " Dashboard.pdf").when(k == 3, ".PDF").otherwise(".txt"))
    files = w.select("loc_name", F.concat_ws("/", F.lit("/in"), "platform", F.date_format(WEEK, "yyyy-MM-dd"), name).alias("path"))
    extra = files.groupBy().agg(F.min("path").alias("path")).select(F.lit("NOWHERE").alias("loc_name"), F.concat("path", F.lit(".xls")).alias("path"))
    return files.unionByName(extra)


def file_kinds(spark, sf_dir):
    return file_parts(_files(spark, sf_dir)).select("path", "bucket", WEEK, "kind")


def file_groups(spark, sf_dir):
    """Files by kind and week."""
    f = file_parts(_files(spark, sf_dir)).where("kind IS NOT NULL")
    return f.groupBy(WEEK, "kind").agg(F.count("*").alias("n_files"), F.min("file").alias("first_file"))


def weeks_on_disk(spark, sf_dir):
    return file_parts(_files(spark, sf_dir)).where("kind IS NOT NULL").select(WEEK).distinct()


def file_coverage(spark, sf_dir):
    return coverage(_files(spark, sf_dir), facts.places(spark, sf_dir), "loc_name")


def ready_reports(spark, sf_dir):
    """Manifest entries whose status is ready and whose file is a PDF, and attachments of known senders with a report's suffix."""
    f = file_parts(_files(spark, sf_dir)).withColumns({"status": F.when(F.dayofmonth(WEEK) <= 20, "ready").otherwise("held"), "sender": F.when(F.dayofmonth(WEEK) % 2 == 0, "known").otherwise("stranger")})
    pdf, attached = F.lower("file").endswith(".pdf") & (F.col("status") == "ready"), F.col("kind").isNotNull() & (F.col("sender") == "known")
    return f.where(pdf | attached).select("path", pdf.alias("is_ready"), attached.alias("is_attachment"))


def _issues(spark, sf_dir) -> DataFrame:
    c = trust.completeness_checks(spark, sf_dir).where("status <> 'pass'")
    return c.select(*KEYS, F.upper("name").alias("code"), F.when(F.col("status") == "fail", "error").otherwise("warning").alias("severity"))


def accepted_issues(spark, sf_dir):
    """Errors that stand after those of every location ending in 3 were accepted."""
    i = _issues(spark, sf_dir)
    accepted = facts.places(spark, sf_dir).where(F.col("loc_name").endswith("3")).select(F.concat("loc_name", F.lit(":CATEGORY_TOTAL")).alias("code"))
    return open_issues(i, accepted).select(*KEYS, "code")


def validation_summary(spark, sf_dir):
    """Issues by severity and code, the most frequent first."""
    s = _issues(spark, sf_dir).groupBy("severity", "code").agg(F.count("*").alias("n"), F.count_distinct("loc_name").alias("n_locations"))
    return s.withColumn("place", F.row_number().over(Window.partitionBy("severity").orderBy(F.col("n").desc(), "code")).cast("long"))


def mediation_events(spark, sf_dir):
    """An event for each location-month whose stylists' sum differs from what is stated: the drift and its share. Stated are sales less refunds."""
    li = facts.lines(spark, sf_dir).withColumn("year_month", facts.year_month(F.col(WEEK)))
    g = li.groupBy("loc_name", "year_month").agg(F.sum("net").alias("summed"), F.sum(F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("net")).cast(facts.MONEY)).alias("stated"))
    out = kpi.plain(g.where("summed <> stated").withColumn("drift", F.col("summed") - F.col("stated")), ["loc_name", "year_month", "summed", "stated", "drift"])
    return out.withColumn("drift_pct", F.when(F.col("stated") != 0, F.col("drift") / F.col("stated"))).withColumn("flag", F.when(F.abs("drift_pct") > 0.05, "MISMATCH").otherwise("DRIFT"))


def manifest_status(spark, sf_dir):
    """Files after a run: those with flags need review, other processed ones are done, what is no report stays."""
    f = file_parts(_files(spark, sf_dir))
    flags = trust.completeness_checks(spark, sf_dir).where("status = 'fail'").groupBy(*KEYS).agg(F.count("*").alias("n_flags"))
    out = f.join(flags, KEYS, "left").withColumn("n_flags", F.coalesce("n_flags", F.lit(0)).cast("long"))
    return out.select("path", "n_flags", F.when(F.col("kind").isNull(), "ignored").when(F.col("n_flags") > 0, "review").otherwise("processed").alias("status"))


QUERIES = {
    f.__name__: f
    for f in (
        schema_headers, schema_fingerprints, cross_file_totals, run_validation, atomic_gate, batch_trust, integrity_report, file_kinds, file_groups, weeks_on_disk, file_coverage, ready_reports,
        accepted_issues, validation_summary, mediation_events, manifest_status,
    )
}


def _header_sql(system: str) -> str:
    names = HEADERS[system]
    loud = ", ".join(f"' {n.upper()}'" for n in names)
    short, late = ", ".join(f"'{n}'" for n in names[:3]), ", ".join(f"'{n}'" for n in (*names[:3], "Time"))
    return f"CASE WHEN weekofyear(week_ending) % 9 = 0 THEN [{short}] WHEN week_ending >= DATE '1998-01-01' THEN [{late}] ELSE [{loud}] END"


_HEADS = f"""{facts.WEEKS_SQL},
hd AS (SELECT loc_name, week_ending, CASE WHEN dayofyear(week_ending) % 11 = 0 THEN 'other' ELSE platform END AS system, weekofyear(week_ending) % 9 = 0 OR week_ending >= DATE '1998-01-01' AS bad,
  CASE WHEN platform = 'zenoti' THEN {_header_sql("zenoti")} ELSE {_header_sql("salon_ultimate")} END AS header FROM lw),
sch AS (SELECT loc_name, week_ending, system, CASE WHEN system = 'other' THEN 'warn' WHEN bad THEN 'fail' ELSE 'pass' END AS status, CASE WHEN system = 'other' THEN 5 WHEN bad THEN 100 ELSE 0 END AS severity FROM hd)"""
_COMP, _ANOM = trust.ORACLE["completeness_checks"], trust.ORACLE["anomaly_wow"]
_VERDICT = f"""{_HEADS},
every AS (SELECT loc_name, week_ending, status, severity FROM sch UNION ALL SELECT loc_name, week_ending, status, severity FROM ({_COMP}) UNION ALL SELECT loc_name, week_ending, status, severity FROM ({_ANOM})),
vs AS (SELECT loc_name, week_ending, greatest(0, 100 - sum(CASE WHEN status <> 'pass' THEN severity ELSE 0 END))::BIGINT AS score, count(*) FILTER (status = 'fail') AS n_fail, count(*) FILTER (status = 'warn') AS n_warn FROM every GROUP BY 1, 2),
vd AS (SELECT *, CASE WHEN n_fail > 0 THEN 'reject' WHEN score >= 85 THEN 'approve' WHEN score >= 70 THEN 'review' ELSE 'hold' END AS verdict FROM vs)"""
_FILES = f"""{facts.WEEKS_SQL},
f0 AS (SELECT loc_name, week_ending, platform, dayofyear(week_ending) % 5 AS k FROM lw WHERE loc_name NOT LIKE '%7'),
f1 AS (SELECT loc_name, week_ending, '/in/' || platform || '/' || week_ending || '/' || loc_name || ['.xls', '.xlsx', ' Dashboard.pdf', '.PDF', '.txt'][k + 1] AS path FROM f0),
f2 AS (SELECT * FROM f1 UNION ALL SELECT 'NOWHERE', NULL, min(path) || '.xls' FROM f1),
fs AS (SELECT f2.loc_name, path, split_part(path, '/', 3) AS bucket, split_part(path, '/', 4)::DATE AS week_ending, split_part(path, '/', 5) AS file,
  CASE WHEN path LIKE '%.xls' THEN 'su_excel' WHEN path LIKE '%.xlsx' THEN 'zenoti_excel' WHEN path LIKE '% Dashboard.pdf' THEN 'su_pdf' WHEN path LIKE '%.PDF' THEN 'zenoti_pdf' END AS kind FROM f2)"""
ORACLE = {
    "schema_headers": f"WITH {_HEADS} SELECT * FROM sch",
    "schema_fingerprints": f"""WITH {_HEADS}, p AS (SELECT loc_name, week_ending, sha256(array_to_string(list_transform(header, lambda x: lower(trim(x))), '|')) AS fingerprint FROM hd)
SELECT *, CASE WHEN row_number() OVER w = 1 THEN 'stored' WHEN fingerprint = first_value(fingerprint) OVER w THEN 'pass' ELSE 'fail' END AS status FROM p WINDOW w AS (PARTITION BY loc_name ORDER BY week_ending)""",
    "cross_file_totals": f"""WITH {facts.WEEKS_SQL}, z AS (SELECT loc_name, week_ending, (service + product)::DOUBLE AS t, CASE weekofyear(week_ending) % 13 WHEN 0 THEN 4.0::DOUBLE WHEN 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS x FROM lw),
y AS (SELECT loc_name, week_ending, t / nullif(t * x, 0) AS share FROM z)
SELECT *, CASE WHEN share > 1.1::DOUBLE THEN 'fail' WHEN share < 0.3::DOUBLE THEN 'warn' ELSE 'pass' END AS status, CASE WHEN share > 1.1::DOUBLE THEN 40 WHEN share < 0.3::DOUBLE THEN 15 ELSE 0 END AS severity FROM y""",
    "run_validation": f"WITH {_VERDICT} SELECT * FROM vd",
    "atomic_gate": f"WITH {_VERDICT} SELECT loc_name, week_ending, guests FROM lw WHERE week_ending NOT IN (SELECT week_ending FROM vd WHERE verdict = 'reject')",
    "batch_trust": f"""WITH {_VERDICT} SELECT week_ending, count(*) AS n_locations, count(*) FILTER (verdict = 'approve') AS n_approve, count(*) FILTER (verdict = 'review') AS n_review, count(*) FILTER (verdict = 'hold') AS n_hold,
  count(*) FILTER (verdict = 'reject') AS n_reject, min(score) AS least, sum(score)::DOUBLE / count(*) AS mean, count(*) FILTER (verdict = 'reject') = 0 AS write FROM vd GROUP BY 1""",
    "integrity_report": f"""WITH {_VERDICT} SELECT week_ending, string_agg(loc_name || ': ' || score || ' ' || verdict, chr(10) ORDER BY loc_name || ': ' || score || ' ' || verdict) || chr(10) || 'batch: ' || min(score) AS report FROM vd GROUP BY 1""",
    "file_kinds": f"WITH {_FILES} SELECT path, bucket, week_ending, kind FROM fs",
    "file_groups": f"WITH {_FILES} SELECT week_ending, kind, count(*) AS n_files, min(file) AS first_file FROM fs WHERE kind IS NOT NULL GROUP BY 1, 2",
    "weeks_on_disk": f"WITH {_FILES} SELECT DISTINCT week_ending FROM fs WHERE kind IS NOT NULL",
    "file_coverage": f"""WITH {_FILES}, l AS (SELECT DISTINCT loc_name FROM places), f AS (SELECT DISTINCT loc_name FROM fs)
SELECT coalesce(l.loc_name, f.loc_name) AS loc_name, CASE WHEN f.loc_name IS NULL THEN 'missing' WHEN l.loc_name IS NULL THEN 'unmapped' ELSE 'ok' END AS status FROM l FULL JOIN f ON l.loc_name = f.loc_name""",
    "ready_reports": f"""WITH {_FILES}, x AS (SELECT path, path ILIKE '%.pdf' AND day(week_ending) <= 20 AS is_ready, kind IS NOT NULL AND day(week_ending) % 2 = 0 AS is_attachment FROM fs) SELECT * FROM x WHERE is_ready OR is_attachment""",
    "accepted_issues": f"SELECT loc_name, week_ending, upper(name) AS code FROM ({_COMP}) WHERE status = 'fail' AND NOT (upper(name) = 'CATEGORY_TOTAL' AND loc_name LIKE '%3')",
    "validation_summary": f"""WITH i AS (SELECT loc_name, upper(name) AS code, CASE WHEN status = 'fail' THEN 'error' ELSE 'warning' END AS severity FROM ({_COMP}) WHERE status <> 'pass'),
s AS (SELECT severity, code, count(*) AS n, count(DISTINCT loc_name) AS n_locations FROM i GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY severity ORDER BY n DESC, code) AS place FROM s""",
    "mediation_events": f"""WITH {facts.LINES_SQL}, g AS (SELECT loc_name, strftime(week_ending, '%Y-%m') AS year_month, sum(net) AS summed, sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE net END) AS stated FROM lines GROUP BY ALL),
d AS (SELECT loc_name, year_month, summed::DOUBLE AS summed, stated::DOUBLE AS stated, (summed - stated)::DOUBLE AS drift FROM g WHERE summed <> stated), p AS (SELECT *, CASE WHEN stated <> 0 THEN drift / stated END AS drift_pct FROM d)
SELECT *, CASE WHEN abs(drift_pct) > 0.05::DOUBLE THEN 'MISMATCH' ELSE 'DRIFT' END AS flag FROM p""",
    "manifest_status": f"""WITH {_FILES}, b AS (SELECT loc_name, week_ending, count(*) AS n FROM ({_COMP}) WHERE status = 'fail' GROUP BY 1, 2)
SELECT path, coalesce(n, 0) AS n_flags, CASE WHEN kind IS NULL THEN 'ignored' WHEN coalesce(n, 0) > 0 THEN 'review' ELSE 'processed' END AS status FROM fs LEFT JOIN b ON b.loc_name = fs.loc_name AND b.week_ending = fs.week_ending""",
}
