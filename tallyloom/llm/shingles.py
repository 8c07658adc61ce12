"""Near-duplicates by the Jaccard similarity of word shingles: SimHash and MinHash bands find candidates, their texts' shingle sets decide.

Texts link if their sets of WORDS-word shingles have a Jaccard similarity of SIMILARITY at least. Texts with equal sets are one class.
Fingerprints of the classes' sets are linked by BK-trees, as in simhash; classes whose fingerprints one tree links form a bucket. At 0.8 two
fingerprints differ in about ten bits, far beyond the radius, so a class also has BANDS keys of ROWS minima each: two sets of similarity s share a key with a chance of 1 - (1 - s ** ROWS) ** BANDS, which is
0.996 at 0.8 and 0.99998 at 0.9. Classes that share a key form a bucket too; buckets with the same members are compared once, and every pair in
a bucket that is not yet connected is compared exactly. A hot bucket is dealt to tiles of bounded size, and each task emits a spanning
forest of the links it finds, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import simhash
from tallyloom.llm.common import LOWER, UPPER, fewer, stored
from tallyloom.llm.components import connected_components

WORDS, SEED, BANDS, ROWS = 5, 42, 14, 5
#: Least similarity, as a fraction, so that it is compared in whole numbers.
SIMILARITY = (4, 5)
#: Classes, and characters of their texts, in a part of a bucket at most, as far as the hash deals them evenly; a tile holds two parts.
PART, CHARS = 1024, 8_000_000

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_SEEDS = np.random.default_rng(SEED).integers(0, 2**64, (2, BANDS * ROWS, 1), np.uint64)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles; a shorter text is one shingle. Empty without words."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    digest = xxhash.xxh64_intdigest
    n = max(1, len(found) - words + 1) if found else 0
    return np.unique(np.fromiter((digest(b" ".join(found[i : i + words]), SEED) for i in range(n)), np.uint64, n))


def band_keys(hashes: np.ndarray) -> list[int]:
    """The signed keys of a set's bands; none for an empty set."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.uint64(2**64 - 1))
    for at in range(0, len(hashes), 4096):
        x = (hashes[None, at : at + 4096] ^ _SEEDS[0]) * (_SEEDS[1] | np.uint64(1))
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(least, x.min(axis=1), out=least)
    return [xxhash.xxh64_intdigest(b.tobytes()) - (1 << 63) for b in least.reshape(BANDS, ROWS)]


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, hash, node, chars, fp, keys) of every row: node names its shingle set, whose fingerprint is fp (null for an empty set), hash its text."""

    def run(batches):
        for b in batches:
            nodes, keys, chars, fps = [], [], [], []
            for t in (x.as_py() for x in b.column(2)):
                s = shingle_set(t)
                nodes.append(xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63))
                keys.append(band_keys(s))
                fps.append(simhash.of_hashes(s) if len(s) else None)
                chars.append(len(t or ""))
            numbers = [pa.array(c, pa.int64()) for c in (nodes, chars, fps)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *numbers, pa.array(keys, pa.list_(pa.int64()))], ["id", "hash", "node", "chars", "fp", "keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"id {kind}, hash long, node long, chars long, fp long, keys array<long>")


def forest(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the least index of its component; every pair that is not yet connected is compared."""
    size = np.array([len(s) for s in sets])
    distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(size)
    starts = ends - size
    labels, mark = simhash.Labels(len(sets)), np.zeros(len(distinct), bool)
    for i in range(len(sets)):
        if not (labels.of[i + 1 :] != labels.of[i]).any():
            continue
        mine = flat[starts[i] : ends[i]]
        mark[mine] = True
        shared = np.add.reduceat(mark[flat[starts[i] :]], starts[i:] - starts[i], dtype=np.int64)
        mark[mine] = False
        like = i + np.flatnonzero(shared * SIMILARITY[1] >= (size[i] + size[i:] - shared) * SIMILARITY[0])
        labels.join(np.full(len(like), i), like)
        while not np.array_equal(up := labels.of[labels.of], labels.of):
            labels.of = up
    return labels.of


def _compare(batches):
    tile, nodes, sets = None, [], []

    def edges():
        of = forest(sets) if len(sets) > 1 else np.zeros(len(sets), np.int64)
        moved = np.flatnonzero(of != np.arange(len(of)))
        at = np.array(nodes, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(at[moved]), pa.array(at[of[moved]])], ["a", "b"])

    for b in batches:
        for *key, node, text in zip(*(b.column(c).to_pylist() for c in ("t", "k", "lo", "hi", "node", "text"))):
            if key != tile:
                if len(nodes) > 1:
                    yield edges()
                tile, nodes, sets = key, [], []
            if not nodes or nodes[-1] != node:  # rows with equal ids and texts come in a row
                nodes.append(node)
                sets.append(shingle_set(text))
    if len(nodes) > 1:
        yield edges()


def fingerprint_keys(classes: DataFrame) -> DataFrame:
    """(node, first, chars, t, k) of classes(node, first, chars, fp): t is -1, k the class's fingerprint, and in further rows those that stand for it in a tree."""
    some = classes.where("fp IS NOT NULL").select("node", "first", "chars", "fp")
    fps = stored(some.select("fp").distinct(), "fingerprints")
    linked = simhash.fingerprint_links(fps).where("a <> b").distinct()
    linked = some.join(linked, F.col("fp") == F.col("a")).select("node", "first", "chars", F.lit(-1).alias("t"), F.col("b").alias("k"))
    return some.select("node", "first", "chars", F.lit(-1).alias("t"), F.col("fp").alias("k")).unionByName(linked)


def band_rows(classes: DataFrame) -> DataFrame:
    """(node, first, chars, t, k) of classes(node, first, chars, keys), t being the band's number."""
    return classes.select("node", "first", "chars", F.posexplode("keys").alias("t", "k"))


def similarity_links(docs: DataFrame, keyed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Edges (a, b) whose components are those of all links found between classes keyed(node, first, chars, t, k) that share t and k."""
    same = [F.count("*").alias("n"), F.sum("chars").alias("chars"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")]
    buckets = keyed.groupBy("t", "k").agg(*same).where("n > 1").groupBy("n", "chars", "x", "y").agg(F.min(F.struct("t", "k")).alias("b"))
    parts = F.ceil(F.greatest(F.col("n") / PART, F.col("chars") / CHARS)).cast("int")
    buckets = buckets.select("b.t", "b.k", F.greatest(parts, F.lit(1)).alias("parts"))
    members = keyed.select("node", "first", "t", "k").join(buckets, ["t", "k"])
    members = members.groupBy("node", "first").agg(F.collect_list(F.struct("t", "k", "parts")).alias("in"))  # BANDS, and a few fingerprints
    members = members.select("node", F.col("first.id").alias("i"), F.col("first.hash").alias("h"), "in")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    rows = rows.join(members, F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("h"))).select("node", "text", F.inline("in"))
    rows = rows.withColumn("c", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).select("*", F.explode(F.expr("sequence(0, parts - 1)")).alias("j"))
    tile = ["t", "k", "lo", "hi"]
    rows = rows.select("t", "k", F.least("c", "j").alias("lo"), F.greatest("c", "j").alias("hi"), "node", "text")
    return rows.repartition(*tile).sortWithinPartitions(*tile, "node").mapInArrow(_compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, component_id) for every row; component_id is the smallest id reachable over links, null if none is known. A null text counts as empty."""
    rows = stored(sketches(docs, id_col, text_col), "sketches", scan=True)
    classes = rows.groupBy("node").agg(F.min("id").alias("rep"), F.min(F.struct("id", "hash", "chars")).alias("first"), F.min("fp").alias("fp"), F.min("keys").alias("keys"))
    classes = stored(classes.select("node", "rep", F.struct("first.id", "first.hash").alias("first"), F.col("first.chars").alias("chars"), "fp", "keys"), "classes")
    keyed = band_rows(classes).unionByName(stored(fingerprint_keys(classes), "fingerprint-keys"))
    links = stored(similarity_links(docs, keyed, id_col, text_col), "links")
    named = stored(classes.select("node", "rep").join(connected_components(links).withColumnRenamed("component", "c"), "node"), "linked")
    least = named.groupBy("c").agg(F.min("rep").alias("least"))
    named = classes.select("node", "rep").join(named.join(least, "c").select("node", "least"), "node", "left").select("node", F.coalesce("least", "rep").alias("component_id"))
    return fewer(rows.select("id", "node").join(named, "node", "left")).select(F.col("id").alias(id_col), "component_id")
