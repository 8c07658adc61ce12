"""A batch that knows what it did before: a manifest of files by path and content, and a log of its runs.

The manifest is a versioned table; a run reads the version in force, reads only files that are new, changed or due for another try, writes
their rows to a folder of the run's number, and puts the next version in force. A run that dies before that has done nothing: the next one
has the same number and replaces its folder. Of two runs at once one is refused.

States: done, failed (is tried again), given_up (failed max_tries times) and copy (another path has the content). A path whose content
changes begins anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.operators.stores import Conflict, commit, current_number, read_current
from tallyloom.sources import facts
from tallyloom.sources.work import stored, work_folder

MANIFEST = "path string, length bigint, modified timestamp, content_sha256 string, state string, tries int, error string, run int"
#: Files that one job reads; their paths go to the driver, where Spark's own file index has them too.
AT_ONCE = 10_000


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, modified) of all files below folder; none is opened. Spark leaves out files without a byte."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", F.col("modificationTime").alias("modified"))


def contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, text, content_sha256) of the given files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.select("path", F.decode("content", "UTF-8").alias("text"), F.sha2("content", 256).alias("content_sha256"))


def due(files: DataFrame, manifest: DataFrame, max_tries: int) -> DataFrame:
    """files(path, length, modified) that the manifest lacks, has otherwise or has as failed, with why (new, changed, again) and the tries
    so far. A copy comes again when the content of every file that it is a copy of has changed."""
    known = manifest.select("path", F.col("length").alias("_l"), F.col("modified").alias("_m"), "content_sha256", "state", "tries")
    rows = files.join(known, "path", "left")
    new, changed = F.col("_l").isNull(), (F.col("_l") != F.col("length")) | (F.col("_m") != F.col("modified"))
    gone = rows.where(changed).select("path")
    held = manifest.where("state = 'done'").join(gone, "path", "left_anti").select("content_sha256", F.lit(True).alias("_held")).distinct()
    rows = rows.join(held, "content_sha256", "left")
    again = (F.col("state") == "failed") & (F.col("tries") < max_tries) | (F.col("state") == "copy") & F.col("_held").isNull()
    rows = rows.withColumn("why", F.when(new, "new").when(changed, "changed").when(again, "again")).where("why IS NOT NULL")
    return rows.select(*files.columns, "why", F.when(F.col("state").isin("failed") & (F.col("why") == "again"), F.col("tries")).otherwise(0).alias("tries"))


def run(spark: SparkSession, folder: str, state: str, sink: str, parse: Callable[[DataFrame], DataFrame], max_tries: int = 3, log_idle: bool = False) -> dict:
    """One run over the files below folder; returns what it says in the run log. A run that finds nothing to do is not in the log and has
    the number of the one before, or with log_idle is a run like others.

    parse takes (path, text, content_sha256) and returns (path, error, row), any number of rows a file: error is null where the file is
    good, else says what is wrong with it, and its rows are not written. A file without rows is good. Of files with equal contents the
    one that is done already, or else the least path, is read into rows; others are copies.
    """
    base, before = current_number(spark, state), read_current(spark, state)
    manifest = before if before is not None else spark.createDataFrame([], MANIFEST)
    number, work = base + 1, work_folder(spark, "manifest")
    todo = stored(due(listed(spark, folder), manifest, max_tries), work)
    paths = [r.path for r in todo.select("path").orderBy("path").toLocalIterator()]
    held = manifest.where("state = 'done'").join(todo.select("path"), "path", "left_anti").select("path", "content_sha256")
    results = []
    for at in range(0, len(paths), AT_ONCE):
        got = stored(contents(spark, paths[at : at + AT_ONCE]), work)
        first = F.first("path").over(Window.partitionBy("content_sha256").orderBy("path"))
        here = got.select("path", "content_sha256", first.alias("_first")).join(held.groupBy("content_sha256").agg(F.min("path").alias("_other")), "content_sha256", "left")
        own = stored(here.withColumn("copy", F.col("_other").isNotNull() | (F.col("_first") != F.col("path"))).drop("_first", "_other"), work)
        read = stored(parse(got.join(own.where("NOT copy").select("path"), "path", "left_semi")), work)
        bad = read.groupBy("path").agg(F.min("error").alias("error"))
        good = read.join(bad.where("error IS NOT NULL").select("path"), "path", "left_anti").join(own.select("path", "content_sha256"), "path")
        mode = "overwrite" if at == 0 else "append"
        good.where("row IS NOT NULL").select("path", "content_sha256", "row.*").write.mode(mode).parquet(f"{sink}/run={number}")
        results.append(own.join(bad, "path", "left"))
        held = held.unionByName(results[-1].where("NOT copy AND error IS NULL").select("path", "content_sha256"))
    if not results and not log_idle:
        return {"run": base, "new": 0, "changed": 0, "again": 0, "done": 0, "failed": 0, "given_up": 0, "copy": 0}
    out = results[0] if results else spark.createDataFrame([], "path string, content_sha256 string, copy boolean, error string")
    for r in results[1:]:
        out = out.unionByName(r)
    failed = F.col("error").isNotNull()
    kind = F.when(F.col("copy"), "copy").when(failed & (F.col("tries") + 1 >= max_tries), "given_up").when(failed, "failed").otherwise("done")
    told = todo.join(out, "path").withColumns({"state": kind, "tries": F.col("tries") + 1, "run": F.lit(number)})
    told = stored(told, work)
    names = [f.split()[0] for f in MANIFEST.split(", ")]
    if not commit(spark, state, manifest.join(told.select("path"), "path", "left_anti").select(names).unionByName(told.select(names)), "manifest", base):
        raise Conflict(f"another run made version {number}")
    n = {f"{c}={v}": k for c in ("why", "state") for v, k in told.groupBy(c).count().collect()}
    said = {"run": number, **{w: n.get(f"why={w}", 0) for w in ("new", "changed", "again")}, **{s: n.get(f"state={s}", 0) for s in ("done", "failed", "given_up", "copy")}}
    spark.createDataFrame([tuple(said.values())], ", ".join(f"{k} long" for k in said)).coalesce(1).write.mode("overwrite").parquet(f"{state}/runs/run={number}")
    return said


def rows_in_force(spark: SparkSession, state: str, sink: str) -> DataFrame:
    """The sink's rows of files that are done, of their present contents only."""
    done = read_current(spark, state).where("state = 'done'").select("path", "content_sha256", "run")
    return spark.read.parquet(sink).join(done, ["path", "content_sha256", "run"], "left_semi").drop("run")


# --- queries: a file a location and year, in three runs


def _parsed(files: DataFrame) -> DataFrame:
    """Lines `location,month,guests`; a file with a line of another kind is bad."""
    line = F.explode_outer(F.filter(F.split("text", "\n"), lambda x: x != ""))
    rows = files.select("path", line.alias("line")).withColumn("p", F.split("line", ","))
    bad = F.col("line").isNotNull() & ((F.size("p") != 3) | F.try_element_at("p", F.lit(3)).cast("string").rlike(r"\D"))
    row = F.when(F.col("line").isNotNull() & ~bad, F.struct(F.col("p")[0].alias("loc_name"), F.try_element_at("p", F.lit(2)).alias("year_month"), F.expr("try_cast(try_element_at(p, 3) AS BIGINT)").alias("guests")))
    return rows.select("path", F.when(bad, F.lit("not a line of three")).alias("error"), row.alias("row"))


def _three_runs(spark, sf_dir) -> tuple[str, str]:
    """Months of all years; the first run sees those of years up to 1994, where every seventh location's file of 1994 is bad; the second
    sees all; before the third the bad ones are mended. Every location's file of 1995 is there twice."""
    work = work_folder(spark, "files")
    places = facts.places(spark, sf_dir).select("loc_name", "loc_id").distinct()
    m = facts.location_months(spark, sf_dir).join(places, "loc_name").withColumn("year", F.substring("year_month", 1, 4).cast("int"))
    m = stored(m.select("loc_name", "loc_id", "year", "year_month", "guests"), work)
    good = F.concat_ws(",", "loc_name", "year_month", F.col("guests").cast("string"))
    line = F.when((F.col("year") == 1994) & (F.col("loc_id") % 7 == 0), F.concat(good, F.lit("?"))).otherwise(good)

    def put(rows: DataFrame, folder: str) -> None:
        one = rows.repartition("year", "loc_id").sortWithinPartitions("year", "loc_id", "value")
        one.write.mode("append").partitionBy("year", "loc_id").text(f"{work}/in/{folder}")

    runs = lambda: run(spark, f"{work}/in", f"{work}/state", f"{work}/sink", _parsed, log_idle=True)
    put(m.where("year <= 1994").select("year", "loc_id", line.alias("value")), "a")
    runs()
    put(m.where("year > 1994").select("year", "loc_id", good.alias("value")), "b")
    put(m.where("year = 1995").select("year", "loc_id", good.alias("value")), "copies")
    runs()
    put(m.where("year = 1994 AND loc_id % 7 = 0").select("year", "loc_id", good.alias("value")), "mended")
    runs()
    return f"{work}/state", f"{work}/sink"


def manifest_runs(spark, sf_dir):
    """The log of three runs over a growing folder."""
    state, _ = _three_runs(spark, sf_dir)
    return spark.read.parquet(f"{state}/runs").select(F.col("run").cast("long").alias("run"), "new", "changed", "again", "done", "failed", "given_up", "copy")


def manifest_rows(spark, sf_dir):
    """The rows in force after them."""
    state, sink = _three_runs(spark, sf_dir)
    return rows_in_force(spark, state, sink).select("loc_name", "year_month", "guests")


QUERIES = {f.__name__: f for f in (manifest_runs, manifest_rows)}
_F = f"""{facts.MONTHS_SQL}, f AS (SELECT loc_name, year, loc_id % 7 = 0 AND year = 1994 AS bad FROM (SELECT DISTINCT loc_name, left(year_month, 4)::INT AS year FROM lm) JOIN (SELECT DISTINCT loc_name, loc_id FROM places) USING (loc_name))"""
ORACLE = {
    "manifest_runs": f"""WITH {_F}, c AS (SELECT count(*) FILTER (year <= 1994) AS a, count(*) FILTER (year > 1994) AS b, count(*) FILTER (year = 1995) AS twice, count(*) FILTER (bad) AS bad FROM f)
SELECT 1 AS run, a AS new, 0 AS changed, 0 AS again, a - bad AS done, bad AS failed, 0 AS given_up, 0 AS copy FROM c UNION ALL SELECT 2, b + twice, 0, bad, b, bad, 0, twice FROM c UNION ALL SELECT 3, bad, 0, bad, bad, 0, bad, 0 FROM c""",
    "manifest_rows": f"WITH {facts.MONTHS_SQL} SELECT loc_name, year_month, guests::BIGINT AS guests FROM lm",
}
