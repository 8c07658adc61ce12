"""Periodic runs: stretches of words that repeat a shorter stretch at least four times in a row.

Karp, Miller and Rosenberg's names: at level k every place has a number that is equal where the next 2**k words of one document are
equal, made by naming pairs of numbers of the level below. How far two places agree is found by going down the levels once. A run of
period q holds a multiple of q from which 2q words equal those q further on, so only places on that grid are tried, and those that agree
are extended both ways. Documents of a batch lie one behind another in one array; names are of one document, so nothing crosses its end.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import table, text_or_empty

LEAST, TIMES = 6, 4
#: Words that are named together, unless one document has more.
BATCH = 60_000
FIELDS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _named(keys: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """A number for each place, equal where keys are, and -1 where a key occurs once or there is none."""
    names = np.full(size, -1, np.int64)
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = np.where(times > 1, np.cumsum(times > 1) - 1, -1)
    names[places] = again[which]
    return names


def levels(words: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """Names of 1, 2, 4, ... words from each place, as long as any name occurs twice in its document."""
    size = len(words)
    out = [_named(doc.astype(np.int64) * (int(words.max(initial=0)) + 1) + words, np.arange(size), size)]
    while True:
        below, step = out[-1], 1 << (len(out) - 1)
        places = np.flatnonzero(below[: size - step] >= 0) if step < size else np.empty(0, np.int64)
        places = places[below[places + step] >= 0]
        here = _named(below[places] * size + below[places + step], places, size)
        if not (here >= 0).any():
            return out if (out[0] >= 0).any() else []
        out.append(here)


def _agree(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """How many words from a and b on (or, back, before them) are equal."""
    size, length = len(names[0]), np.zeros(len(a), np.int64)
    for k in range(len(names) - 1, -1, -1):
        x, y = (a - length - (1 << k), b - length - (1 << k)) if back else (a + length, b + length)
        inside = np.flatnonzero((x >= 0) & (y < size))
        same = inside[(names[k][x[inside]] == names[k][y[inside]]) & (names[k][x[inside]] >= 0)]
        length[same] += 1 << k
    return length


def find_runs(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) by start, then period, of all runs; words are numbers, doc the document of each, in order of places."""
    names, found, size = levels(words, doc), [], len(words)
    period = 1
    while 2 * period < size:
        j = period.bit_length()  # 2**j words, more than a period and at most two
        if j >= len(names):
            break
        grid = np.arange(0, size - period, period)
        fits = (names[j][grid] == names[j][grid + period]) & (names[j][grid] >= 0)
        first = grid[fits & ~np.concatenate(([False], fits[:-1]))]  # neighbours that both fit are of one stretch
        if len(first):
            found.append(np.stack([first, np.full(len(first), period)], 1))
        period += 1
    if not found:
        return np.empty((0, 3), np.int64)
    at, q = np.concatenate(found).T
    start, end = at - _agree(names, at, at + q, True), at + q + _agree(names, at, at + q, False)
    long = end - start >= np.maximum(LEAST, TIMES * q)
    runs = np.stack([start, end, q], 1)[long]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)  # of equal stretches the smallest period
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def _described(texts: list[list[bytes]]) -> list[tuple]:
    """FIELDS of each document, and its words that are kept."""
    number: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    ids = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
    runs = find_runs(ids, np.repeat(np.arange(len(texts)), sizes)) if len(ids) else np.empty((0, 3), np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    of = np.searchsorted(runs[:, 0], bounds)
    out = []
    for k, words in enumerate(texts):
        mine = runs[of[k] : of[k + 1]] - (bounds[k], bounds[k], 0)
        if not len(mine):
            out.append((0, None, None, None, None, _sha(b""), b" ".join(words)))
            continue
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, mine[:, 0] + mine[:, 2], 1)
        np.add.at(change, mine[:, 1], -1)
        kept = b" ".join(words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist())
        length = mine[:, 1] - mine[:, 0]
        top = int(np.argmax(length))  # the first of the longest
        s, n, q = int(mine[top, 0]), int(length[top]), int(mine[top, 2])
        lines = "".join(f"{a},{b - a},{p}\n" for a, b, p in mine.tolist())
        out.append((len(mine), s, n, q, 1000 * n // q, _sha(lines.encode()), kept))
    return out


def _batches(texts: list[str]):
    held, n = [], 0
    for t in texts:
        words = t.encode("utf-8", "surrogatepass").split()  # of bytes: at the six white-space characters of ASCII only
        if held and n + len(words) > BATCH:
            yield held
            held, n = [], 0
        held.append(words)
        n += len(words)
    if held:
        yield held


def periodic_runs(docs: DataFrame, text_col: str = "text", collapse: bool = False) -> DataFrame:
    """docs with text_col replaced by n_runs, the longest run (start, length, period, exponent_milli) and digests of all runs and of the
    words that stay when each run is cut down to its first period; with collapse, text_col stays and holds those words.

    Words are parted by the six white-space characters of ASCII, whole texts are read, and words are compared exactly, case included. A
    null text has no words, as an empty one: no runs, four nulls, and digests of nothing; with collapse it stays null. Every row has its
    own result, so ids may repeat or be null; columns of docs with the new names are replaced. An empty table gives an empty result. A
    task holds the names of one batch, about ten numbers a word for each level, of which there are as many as repeats are long.
    """
    fields = [f.split() for f in FIELDS.split(", ")]
    new = [n for n, _ in fields]
    names = [c for c in docs.columns if c != text_col and c not in new]
    rest = docs.select(*names, F.col(text_col).isNull().alias("_null"), text_or_empty(text_col).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema.fields)
    schema = ", ".join(filter(None, [schema, f"`{text_col}` string" if collapse else "", FIELDS]))
    kinds = [pa.int64() if t == "long" else pa.string() for _, t in fields]

    def run(batches):
        for b in batches:
            for part in (b.slice(i, 512) for i in range(0, b.num_rows, 512)):
                rows = [r for held in _batches(part.column(part.num_columns - 1).to_pylist()) for r in _described(held)]
                gone = part.column(part.num_columns - 2).to_pylist()
                text = [pa.array([None if g else r[-1] for r, g in zip(rows, gone)], pa.binary()).cast(pa.string())] if collapse else []
                cols = [pa.array(c, k) for c, k in zip(zip(*((*r[:-1], _sha(r[-1])) for r in rows)), kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], *text, *cols], [*names, *([text_col] if collapse else []), *new])

    return rest.mapInArrow(run, schema)


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by the CRC-32 of their ids, repeat a stretch of their words to the end; others as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).cast("long").alias("g"))
    rows = rows.withColumn("n", F.when(F.size("w") > 0, F.size("w").cast("long")))  # null: left as it is
    rows = rows.withColumn("a", F.col("g") % F.col("n"))
    rows = rows.withColumn("p", 1 + F.expr("(n - a) div (3 + g % 8)"))
    again = F.expr("array_join(transform(w, (x, i) -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), again).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs(with_repeats(table(spark, sf_dir, "documents")))


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
ORACLE: dict[str, str] = {}
