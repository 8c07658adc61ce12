"""Sinks that are all or nothing: versioned tables with an audit log, appends of whole periods, logs, and the narrow tables that others read.

A versioned table is a folder of versions and a log of numbered files, each of which names one; the highest number is in force. A log file
is created only if there is none of its number, so of two writers that began from one version only the first goes through. A write that
fails, or whose check fails, leaves a version that the log does not name: the one before stays in force and nothing has to be restored.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import kpi
from tallyloom.operators.contracts import _weeks as wide_weeks
from tallyloom.operators.contracts import CUMULATIVE, location_row
from tallyloom.operators.ledger import append_ledger, existing_rows
from tallyloom.sources import facts
from tallyloom.sources.work import work_folder

AUDIT = "version string, at timestamp, caller string, operation string, n_rows bigint, skipped bigint, status string, batch_sha256 string, error string"
ANOMALY = "period_end date, location string, alert_type string, severity string, message string, source string, at timestamp"


def batch_hash(df: DataFrame) -> list[Column]:
    """Aggregates from which a batch's hash is made: they do not depend on the order of rows and need no row in one place."""
    row = F.xxhash64(F.to_json(F.struct(*(F.col(c) for c in sorted(df.columns)))))
    return [F.count("*").alias("n_rows"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("total"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("mixed")]


def audit(spark: SparkSession, path: str, **row) -> None:
    at = datetime.now(timezone.utc).replace(tzinfo=None)
    names = [f.split()[0] for f in AUDIT.split(", ")]
    spark.createDataFrame([tuple({"at": at, **row}.get(n) for n in names)], AUDIT).coalesce(1).write.mode("append").parquet(f"{path}/audit")


class Conflict(RuntimeError):
    """Another writer was first."""


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless there is one already; says whether it did. Of several writers one succeeds."""
    fs, p = _at(spark, path)
    if fs.getScheme() == "file":  # whose create() looks first and writes then; a link is made in one step
        local = p.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(new := f"{local}.{uuid.uuid4().hex}.tmp", "w") as f:
            f.write(text)
        try:
            os.link(new, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.remove(new)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def log_entries(spark: SparkSession, path: str) -> dict[int, dict]:
    """What the log of the versioned table at path says, by number; a file that is still being written is left out."""
    fs, p = _at(spark, f"{path}/log")
    if not fs.exists(p):
        return {}
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    rows = spark.read.text([f"{path}/log/{n}" for n in names if n.isdigit()], wholetext=True).select("_metadata.file_name", "value").collect() if any(n.isdigit() for n in names) else []
    return {int(n): json.loads(v) for n, v in rows if v.endswith("}")}


def current_number(spark: SparkSession, path: str) -> int:
    """The number of the version in force; 0 before the first."""
    return max(log_entries(spark, path), default=0)


def name_version(spark: SparkSession, path: str, version: str, base: int, **more) -> bool:
    """Puts a version that is written in force as number base + 1, unless there is such a number."""
    at = datetime.now(timezone.utc).isoformat()
    return create_once(spark, f"{path}/log/{base + 1}", json.dumps({"version": version, "at": at, **more}))


def commit(spark: SparkSession, path: str, df: DataFrame, caller: str, base: int) -> bool:
    """Writes df as version base + 1; if another writer made that number first, nothing is changed and the answer is False."""
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/data/{version}")
    if name_version(spark, path, version, base, caller=caller):
        return True
    fs, p = _at(spark, f"{path}/data/{version}")
    fs.delete(p, True)
    return False


def clean_up(spark: SparkSession, path: str, keep: int = 1, older_than: float = 86_400.0) -> list[str]:
    """Removes the folders of versions that neither are among the last `keep` nor younger than so many seconds; returns their names.

    Those left by failed writers go too. A writer or reader that takes longer than older_than would lose its folder.
    """
    entries = log_entries(spark, path)
    stay = {entries[n]["version"] for n in sorted(entries)[-keep:]} if keep else set()
    fs, p = _at(spark, f"{path}/data")
    old = [f.getPath() for f in (fs.listStatus(p) if fs.exists(p) else []) if f.getModificationTime() <= (time.time() - older_than) * 1000 and f.getPath().getName() not in stay]
    for f in old:
        fs.delete(f, True)
    return sorted(f.getName() for f in old)


def safe_overwrite(spark: SparkSession, path: str, df: DataFrame, caller: str, check: Callable[[DataFrame], str | None] = lambda _: None, base: int | None = None) -> str:
    """Writes df as the new version of the table at path and returns its name. check(df) says what is wrong with the version written, or None.

    base is the number that df was made from: if there is a newer one by now, Conflict is raised. Without base the last writer wins. Every
    attempt leaves a row in the audit log; after a failed one readers still see the version before.
    """
    import hashlib

    version, seen = uuid.uuid4().hex, Observation()
    try:
        df.observe(seen, *batch_hash(df)).write.parquet(f"{path}/data/{version}")
        if error := check(spark.read.schema(df.schema).parquet(f"{path}/data/{version}")):
            raise ValueError(error)
        while not name_version(spark, path, version, current_number(spark, path) if base is None else base, caller=caller):
            if base is not None:
                raise Conflict(f"version {base + 1} is there already")
    except Exception as e:
        audit(spark, path, version=version, caller=caller, operation="overwrite", status="failed", error=str(e)[:2000])
        raise
    n = seen.get
    sha = hashlib.sha256(f"{n['n_rows']}|{n['total']}|{n['mixed']}".encode()).hexdigest()
    audit(spark, path, version=version, caller=caller, operation="overwrite", n_rows=n["n_rows"], skipped=0, status="ok", batch_sha256=sha)
    return version


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The version in force; None before the first."""
    entries = log_entries(spark, path)
    return spark.read.parquet(f"{path}/data/{entries[max(entries)]['version']}") if entries else None


def append_period(spark: SparkSession, path: str, batch: DataFrame, period: str) -> int:
    """Appends the batch unless the table has a row of any of its periods: then nothing of it is written. Returns the rows written."""
    existing, seen = existing_rows(spark, path), Observation()
    if existing is not None:
        again = existing.select(period).distinct().join(batch.select(period).distinct(), period, "left_semi")
        batch = batch.where(~F.coalesce(again.agg(F.count("*") > 0).scalar(), F.lit(False)))
    batch.observe(seen, F.count("*").alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def append_log(rows: DataFrame, path: str, schema: str = ANOMALY) -> None:
    """Appends rows to a log, missing columns as null and at as now."""
    names = [f.split()[:2] for f in schema.split(", ")]
    have = rows if "at" in rows.columns else rows.withColumn("at", F.current_timestamp())
    have.select(*((F.col(n) if n in have.columns else F.lit(None)).cast(t).alias(n) for n, t in names)).write.mode("append").parquet(path)


def write_if_clean(spark: SparkSession, path: str, rows: DataFrame, errors: DataFrame, caller: str) -> bool:
    """Writes rows as a new version only if errors has no row; says whether it did."""
    if found := errors.limit(1).count():
        audit(spark, path, caller=caller, operation="gate", n_rows=0, status="blocked", error=f"{found} or more errors")
        return False
    safe_overwrite(spark, path, rows, caller)
    return True


def _folder(spark) -> str:
    return work_folder(spark)


def _months(spark, sf_dir) -> DataFrame:
    return kpi.plain(kpi.with_ratios(facts.location_months(spark, sf_dir)), ["loc_name", "year_month", "guests", "total_sales"])


def sink_append_period(spark, sf_dir):
    """A batch a year, of which one comes twice, changed, and one with a month of the year before: a month that is stored is not written
    again, nor a batch that holds one such month, which comes again without it."""
    m, path = _months(spark, sf_dir), f"{_folder(spark)}/months"
    more = m.withColumn("guests", F.col("guests") + 1)
    year = lambda df, op, y: df.where(F.substring("year_month", 1, 4).cast("int") == y if op == "=" else F.substring("year_month", 1, 4).cast("int") > y)
    for batch in (year(m, "=", 1992), year(more, "=", 1992), *(year(m, "=", y) for y in (1993, 1994, 1995, 1996)), more.where("year_month >= '1996-12'"), year(m, ">", 1996)):
        append_period(spark, path, batch, "year_month")
    return spark.read.schema(m.schema).parquet(path)


def sink_safe_overwrite(spark, sf_dir):
    """A good version, then one that its check refuses: the first is what readers see."""
    m, path = _months(spark, sf_dir), f"{_folder(spark)}/table"
    safe_overwrite(spark, path, m.where("year_month < '1998-01'"), "query")
    try:
        safe_overwrite(spark, path, m.withColumn("guests", -F.col("guests")), "query", lambda d: "negative guests" if d.where("guests < 0").limit(1).count() else None)
    except ValueError:
        pass
    return read_current(spark, path)


def sink_audit(spark, sf_dir):
    """The audit log of a table written, refused, blocked and written again."""
    m, path = _months(spark, sf_dir), f"{_folder(spark)}/table"
    safe_overwrite(spark, path, m, "first")
    try:
        safe_overwrite(spark, path, m, "second", lambda d: "refused")
    except ValueError:
        pass
    write_if_clean(spark, path, m, m, "third")
    write_if_clean(spark, path, m.where("guests > 1"), m.where("guests < 0"), "fourth")
    return spark.read.schema(AUDIT).parquet(f"{path}/audit").select("caller", "operation", "n_rows", "status", "error")


def sink_ledger_counts(spark, sf_dir):
    """What two appends report: months of 1996 with one month twice, then all months."""
    m, path = _months(spark, sf_dir), f"{_folder(spark)}/ledger"
    first = m.where("year_month LIKE '1996%'")
    said = [append_ledger(spark, path, b, ["loc_name", "year_month"], "guests") for b in (first.unionByName(first.where("year_month = '1996-04'")), m)]
    return spark.createDataFrame([(i, s["received"], s["repeated"], s["stored"], s["appended"]) for i, s in enumerate(said, 1)], "batch bigint, received bigint, repeated bigint, stored bigint, appended bigint")


def sink_anomaly_log(spark, sf_dir):
    """Alerts appended to the log in two parts."""
    from tallyloom.operators.emit import recognition_alerts

    path = f"{_folder(spark)}/log"
    a = recognition_alerts(spark, sf_dir).select(F.col("week_ending").alias("period_end"), F.col("loc_name").alias("location"), F.col("kind").alias("alert_type"), "severity", F.lit("alerts").alias("source"))
    for part in ("severity = 'HIGH'", "severity <> 'HIGH'"):
        append_log(a.where(part), path)
    return spark.read.schema(ANOMALY).parquet(path).groupBy("alert_type", "severity").agg(F.count("*").alias("n"), F.count("message").alias("n_messages"), F.count("at").alias("n_dated"))


def sink_narrow_rows(spark, sf_dir):
    """The wide location rows written in their narrow form, a partition a month, of which one is replaced: the others stay."""
    from tallyloom.operators.ledger import overwrite_snapshot

    path = f"{_folder(spark)}/narrow"
    r = location_row(wide_weeks(spark, sf_dir)).select(F.date_format("period_end", "yyyy-MM").alias("year_month"), F.col("period_end").alias("week_ending"), *(F.col(a).alias(b) for b, a in CUMULATIVE.items()))
    overwrite_snapshot(r, path, "year_month")
    overwrite_snapshot(r.where("year_month = '1997-03' AND guests > 3"), path, "year_month")
    return spark.read.parquet(path).select(F.col("year_month").cast("string").alias("year_month"), "loc_name", "week_ending", "guests", "total_sales")


QUERIES = {f.__name__: f for f in (sink_append_period, sink_safe_overwrite, sink_audit, sink_ledger_counts, sink_anomaly_log, sink_narrow_rows)}

_M = f"{facts.MONTHS_SQL}, m AS (SELECT loc_name, year_month, guests::BIGINT AS guests, (service + product)::DOUBLE AS total_sales FROM lm)"
_COLS = "loc_name, year_month, guests, total_sales"


def _alerts() -> str:
    from tallyloom.operators.emit import ORACLE

    return ORACLE["recognition_alerts"]


ORACLE = {
    "sink_append_period": f"WITH {_M} SELECT {_COLS} FROM m",
    "sink_safe_overwrite": f"WITH {_M} SELECT {_COLS} FROM m WHERE year_month < '1998-01'",
    "sink_audit": f"""WITH {_M}, j AS (SELECT * FROM m)
SELECT 'first' AS caller, 'overwrite' AS operation, (SELECT count(*) FROM j) AS n_rows, 'ok' AS status, NULL AS error UNION ALL SELECT 'second', 'overwrite', NULL, 'failed', 'refused'
UNION ALL SELECT 'third', 'gate', 0, 'blocked', '1 or more errors' UNION ALL SELECT 'fourth', 'overwrite', (SELECT count(*) FROM j WHERE guests > 1), 'ok', NULL""",
    "sink_ledger_counts": f"""WITH {_M}, c AS (SELECT count(*) AS n, count(*) FILTER (year_month LIKE '1996%') AS a, count(*) FILTER (year_month = '1996-04') AS b FROM m)
SELECT 1 AS batch, a + b AS received, b AS repeated, 0 AS stored, a AS appended FROM c UNION ALL SELECT 2, n, 0, a, n - a FROM c""",
    "sink_anomaly_log": f"SELECT kind AS alert_type, severity, count(*) AS n, 0 AS n_messages, count(*) AS n_dated FROM ({_alerts()}) GROUP BY 1, 2",
    "sink_narrow_rows": f"""WITH {facts.WEEKS_SQL} SELECT year_month, loc_name, week_ending, guests::DOUBLE AS guests, service::DOUBLE + product::DOUBLE AS total_sales FROM lw WHERE year_month <> '1997-03' OR guests > 3""",
}
