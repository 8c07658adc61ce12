"""Incremental ingest: a file stream into a keyed ledger, and a keyed state machine with a grace period.

Batches are appended through foreachBatch; a batch replayed after a failure finds its keys stored and adds nothing.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyloom.operators.ledger import append_ledger
from tallyloom.sources.work import work_folder


def stream_to_ledger(stream: DataFrame, ledger: str, checkpoint: str, keys: list[str], *order: str) -> None:
    """Takes all that is available now from the stream into the ledger, each key once."""

    def append(batch: DataFrame, _: int) -> None:
        append_ledger(batch.sparkSession, ledger, batch, keys, *order)

    stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def grace_period(stream: DataFrame, key: str, place: str, time: str, needed: int = 2) -> DataFrame:
    """(key, from_place, to_place, seen): a change of place counts once `needed` rows in a row show the new one.

    A key's rows of a batch are gathered and go by time, so its rows of one batch must fit a task. Rows that come in a later batch count
    after those before it, whatever their time: late rows can change which moves are confirmed, and are not sorted in.
    """

    def run(k, batches, state: GroupState):
        home, candidate, n = state.get if state.exists else (None, None, 0)
        out = []
        rows = pd.concat([pdf[[place, time]] for pdf in batches]).sort_values([time, place], kind="stable")
        for at, when in rows.itertuples(index=False):
            if home is None or at == home:
                home, candidate, n = home or at, None, 0
                continue
            n = n + 1 if at == candidate else 1
            candidate = at
            if n >= needed:
                out.append((k[0], home, at, when))
                home, candidate, n = at, None, 0
        state.update((home, candidate, n))
        yield pd.DataFrame(out, columns=[key, "from_place", "to_place", "seen"])

    kinds = dict(stream.dtypes)
    schema = f"{key} {kinds[key]}, from_place {kinds[place]}, to_place {kinds[place]}, seen {kinds[time]}"
    return stream.groupBy(key).applyInPandasWithState(run, schema, f"home {kinds[place]}, candidate {kinds[place]}, n int", "append", GroupStateTimeout.NoTimeout)


def moved(rows: list[tuple], state: tuple, end, needed: int, patience) -> tuple[list[tuple], tuple]:
    """The rule of timed_grace_period over (time, place) rows in order, up to `end`: what it says, and (home, candidate, since, n) afterwards."""
    home, candidate, since, n = state
    out = []
    for when, at in [*rows, (end, None)]:
        if candidate is not None and when > since + patience:
            out.append((home, candidate, since, "expired"))
            candidate, since, n = None, None, 0
        if at is None:
            continue
        if home is None or at == home:
            home, candidate, since, n = home if home is not None else at, None, None, 0
        elif at != candidate:
            candidate, since, n = at, when, 1
        else:
            n += 1
        if candidate is not None and n >= needed:
            out.append((home, at, when, "confirmed"))
            home, candidate, since, n = at, None, None, 0
    return out, (home, candidate, since, n)


def timed_grace_period(stream: DataFrame, key: str, place: str, time: str, late: str = "1 day", needed: int = 2, days: int = 14) -> DataFrame:
    """(key, from_place, to_place, seen, how) by event time: a change of place is confirmed by the row that shows the new one for the
    `needed`th time in a row, and expires if that takes more than `days` from the first one, even if no row of the key comes any more.

    A key's rows wait in the state until the watermark, `late` behind the newest row of the stream, has passed them, and then count in the
    order of their times (ties by place). So rows in any order that are no later than that give what they give in order; later ones are
    dropped. A key's waiting rows are few: those of the last `late`. Rows without a time, place or key are left out. time must be a
    timestamp. Times are whole microseconds in the state and in the rule, for a key has few rows and each is looked at alone.
    """
    patience = days * 86_400_000_000

    def run(k, batches, state: GroupState):
        home, candidate, since, n, waiting = state.get if state.exists else (None, None, None, 0, "[]")
        mark = state.getCurrentWatermarkMs() * 1000
        rows = [(t, p) for t, p in json.loads(waiting)]
        for pdf in batches:
            rows += zip(pdf[time].to_numpy().astype("datetime64[us]").astype("int64").tolist(), pdf[place].tolist())
        rows.sort()
        ready = [r for r in rows if r[0] < mark]
        rows = rows[len(ready) :]
        out, (home, candidate, since, n) = moved(ready, (home, candidate, since, n), mark, needed, patience)
        state.update((home, candidate, since, n, json.dumps(rows)))
        ends = [x for x in (rows[0][0] if rows else None, since + patience if since is not None else None) if x is not None]
        if ends:
            state.setTimeoutTimestamp(min(ends) // 1000)  # called again as soon as the watermark is beyond it
        if out:
            left, to, seen, how = zip(*out)
            yield pd.DataFrame({key: k * len(out), "from_place": left, "to_place": to, "seen": np.array(seen, "datetime64[us]"), "how": how})

    kinds = dict(stream.dtypes)
    rows = stream.select(key, F.col(place).cast("string").alias(place), F.col(time).cast("timestamp").alias(time)).na.drop().withWatermark(time, late)
    schema = f"{key} {kinds[key]}, from_place string, to_place string, seen timestamp, how string"
    return rows.groupBy(key).applyInPandasWithState(run, schema, "home string, candidate string, since long, n int, waiting string", "append", GroupStateTimeout.EventTimeTimeout)


def write_batch(batch: DataFrame, number: int, ledger: str) -> None:
    """Writes a batch to its own folder; done again, it replaces what it wrote, so a replayed batch adds nothing."""
    batch.write.mode("overwrite").parquet(f"{ledger}/batch={number}")


def stream_once(stream: DataFrame, ledger: str, checkpoint: str, keys: list[str], time: str, late: str = "1 day") -> None:
    """Takes all that is available now into the ledger, each key once among rows that are at most `late` apart in time.

    The keys of that span are in the stream's state, so a batch costs what it holds and the ledger is never read. Batches are idempotent
    by their numbers. Of rows with one key the first that comes stays; keys that come again after the span count as new, unlike in
    stream_to_ledger, which looks up every key ever stored.
    """
    once = stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
    once.writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, ledger)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _events(spark, sf_dir) -> DataFrame:
    """The events table as a file stream, whether it is one file or a folder of parts."""
    path = f"{sf_dir}/events.parquet"
    table = spark.read.parquet(path)
    stream = spark.readStream.schema(table.schema)
    if any(f.rstrip("/").endswith("/events.parquet") for f in table.inputFiles()):
        return stream.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.parquet(path)


def stream_ledger_append(spark, sf_dir):
    """Events into a ledger of the first event of each user, kind and day; the stream runs twice, the second time for nothing."""
    folder = work_folder(spark, "stream")
    events = _events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    for run in range(2):
        stream_to_ledger(events, f"{folder}/ledger", f"{folder}/checkpoint-{run}", ["user_id", "event_type", "day"], "ts", "event_id")
    return spark.read.parquet(f"{folder}/ledger").groupBy("event_type", "day").agg(F.count("*").alias("n_users"), F.sum("event_id").alias("event_ids"))


def stream_windows(spark, sf_dir):
    """Tumbling days with a watermark, in append mode: the last day stays open."""
    folder, name = work_folder(spark, "stream"), f"w_{uuid.uuid4().hex}"
    events = _events(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    days = events.withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"))
    out = days.select(F.to_date("window.start").alias("day"), "event_type", "n").writeStream.format("parquet").outputMode("append")
    out.option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/c-{name}").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("day date, event_type string, n long").parquet(f"{folder}/{name}")


def stream_grace_period(spark, sf_dir):
    """Confirmed changes of each user's kind of event."""
    folder = work_folder(spark, "stream")
    out = grace_period(_events(spark, sf_dir).select("user_id", "event_type", "ts"), "user_id", "event_type", "ts")
    out.writeStream.format("parquet").option("path", f"{folder}/moves").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("user_id bigint, from_place string, to_place string, seen timestamp_ntz").parquet(f"{folder}/moves").groupBy("user_id").agg(F.count("*").alias("n_moves"), F.max("seen").alias("last_seen"))


def stream_timed_moves(spark, sf_dir):
    """Confirmed and expired changes of each user's kind of event, by event time, as far as the watermark came."""
    folder = work_folder(spark, "stream")
    out = timed_grace_period(_events(spark, sf_dir).select("user_id", "event_type", "ts"), "user_id", "event_type", "ts", days=2)
    out.writeStream.format("parquet").option("path", f"{folder}/moves").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()
    moves = spark.read.schema("user_id bigint, from_place string, to_place string, seen timestamp, how string").parquet(f"{folder}/moves")
    return moves.groupBy("user_id", "how").agg(F.count("*").alias("n"), F.max(F.to_date("seen")).alias("last_day"))


def stream_once_a_day(spark, sf_dir):
    """Users and kinds once a day of event time, from a stream whose state is as wide as the table; a second run from the checkpoint adds nothing."""
    folder = work_folder(spark, "stream")
    events = _events(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type").withColumn("day", F.to_date("ts"))
    for _ in range(2):
        stream_once(events, f"{folder}/ledger", f"{folder}/checkpoint", ["user_id", "event_type", "day"], "ts", "3650 days")
    return spark.read.parquet(f"{folder}/ledger").groupBy("event_type", "day").agg(F.count("*").alias("n_users"))


QUERIES = {f.__name__: f for f in (stream_ledger_append, stream_windows, stream_grace_period, stream_timed_moves, stream_once_a_day)}
ORACLE = {
    "stream_timed_moves": """WITH m AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY AS mark FROM events),
o AS (SELECT user_id, event_type, ts, lag(event_type) OVER w AS before, lag(ts) OVER w AS before_ts, lead(ts) OVER w AS next_ts, row_number() OVER w AS n, mark FROM events, m WHERE ts < mark WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type)),
p AS (SELECT *, n = 1 OR event_type = before AND ts <= before_ts + INTERVAL 2 DAY AS holds FROM o),
h AS (SELECT *, last_value(CASE WHEN holds THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS home FROM p),
r AS (SELECT user_id, ts, CASE WHEN holds THEN 'confirmed' ELSE 'expired' END AS how FROM h WHERE n > 1 AND event_type <> home AND (holds OR coalesce(next_ts, mark) > ts + INTERVAL 2 DAY))
SELECT user_id, how, count(*) AS n, max(ts)::DATE AS last_day FROM r GROUP BY 1, 2""",
    "stream_once_a_day": "SELECT event_type, ts::DATE AS day, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1, 2",
    "stream_ledger_append": """WITH f AS (SELECT *, ts::DATE AS day FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type, ts::DATE ORDER BY ts, event_id) = 1)
SELECT event_type, day, count(*) AS n_users, sum(event_id)::BIGINT AS event_ids FROM f GROUP BY 1, 2""",
    "stream_grace_period": """WITH o AS (SELECT user_id, event_type, ts, lag(event_type) OVER w AS before, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type)),
h AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY n) AS home FROM o WHERE n = 1 OR event_type = before)
SELECT user_id, count(*) AS n_moves, max(ts) AS last_seen FROM h WHERE n > 1 AND event_type <> home GROUP BY 1""",
    "stream_windows": """SELECT ts::DATE AS day, event_type, count(*) AS n FROM events WHERE ts::DATE + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""",
}
