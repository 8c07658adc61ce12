"""SimHash near-duplicates: fingerprints, BK-trees over shards of them, and the components of their links.

A link joins two fingerprints that differ in at most RADIUS bits. The fingerprint's 64 bits are cut into blocks; two linked
fingerprints agree on at least (blocks - RADIUS) whole blocks, so for every choice of that many blocks the distinct
fingerprints that agree on it form a shard, and no link is lost. A shard becomes one BK-tree, or several of at most TREE nodes
where it is hot, and each tree meets the fingerprints of its own shard: trees travel by shuffle and not as one broadcast,
because all trees together grow with the corpus. Each task emits a spanning forest of the links it finds, never the pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import LOWER, UPPER, fewer, stored, table
from tallyloom.llm.components import connected_components

WORDS, SEED, RADIUS = 4, 42, 4
#: Nodes of one BK-tree at most; a larger shard is dealt to several trees.
TREE = 4096
#: Expected fingerprints a shard; more blocks are taken, still exactly, as the corpus grows.
SHARD = 256
#: (query, node) pairs held at once while trees are searched.
FRONTIER = 1_000_000

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Signed 64-bit SimHash of a text's word shingles, repeats included; zero without words."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not found:
        return 0
    joined, ends = b" ".join(found), np.cumsum([len(w) + 1 for w in found]) - 1
    n = max(1, len(found) - words + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(words, len(found)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return of_hashes(np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, stops)), np.uint64, n))


def of_hashes(h: np.ndarray) -> int:
    """Signed 64-bit SimHash of 64-bit hashes: a bit is set if it is in over half of them."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):  # a very long text takes bounded memory
        ones += np.unpackbits(h[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id_col, fp) for every row; a null text counts as empty. Reads no other column."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t, words) for t in (x.as_py() for x in b.column(1))], pa.int64())], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


class BKForest:
    """BK-trees of many shards at once, as arrays. A node's children are keyed by their integer Hamming distance to it."""

    def __init__(self, fp: np.ndarray, shard: np.ndarray):
        self.fp = fp
        _, first, inverse = np.unique(shard, return_index=True, return_inverse=True)
        self.root = first[inverse]
        code, child = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        wait = np.setdiff1d(np.arange(len(fp)), first)
        at = self.root[wait]
        while len(wait):
            key = at * 65 + np.bitwise_count(fp[wait] ^ fp[at]).astype(np.int64)
            keys, head, inverse = np.unique(key, return_index=True, return_inverse=True)
            code.append(keys)
            child.append(wait[head])
            rest = np.ones(len(wait), bool)
            rest[head] = False
            wait, at = wait[rest], wait[head][inverse[rest]]
        code, child = np.concatenate(code), np.concatenate(child)
        order = np.argsort(code)
        self.code, self.child = code[order], child[order]

    def search(self, query: np.ndarray, root: np.ndarray, radius: int):
        """Yields (index into query, node) arrays with distance <= radius, following only edges within the radius."""
        q, node = np.arange(len(query)), root
        while len(q):
            d = np.bitwise_count(query[q] ^ self.fp[node]).astype(np.int64)
            hit = d <= radius
            yield q[hit], node[hit]
            lo = np.searchsorted(self.code, node * 65 + np.maximum(d - radius, 0))
            n = np.searchsorted(self.code, node * 65 + np.minimum(d + radius, 64), "right") - lo
            q = np.repeat(q, n)
            node = self.child[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(len(q))]


class Labels:
    """Union by smallest index, in arrays."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            while not np.array_equal(up := self.of[self.of], self.of):
                self.of = up
            ra, rb = self.of[a], self.of[b]
            open_ = ra != rb
            if not open_.any():
                return
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(self.of, np.maximum(ra, rb), np.minimum(ra, rb))


def _forest_edges(fp: np.ndarray, tile: np.ndarray, tree: np.ndarray, radius: int):
    """Spanning-forest edges of the links between each tile's tree nodes and its other rows (of its own nodes, where it has no others)."""
    nodes = np.flatnonzero(tree)
    forest = BKForest(fp[nodes], tile[nodes])
    tiles, size = np.unique(tile[nodes], return_counts=True)
    root = np.zeros(int(tile.max()) + 1, np.int64)
    root[tile[nodes]] = forest.root
    weight = np.zeros(len(root), np.int64)
    weight[tiles] = size
    has_others = np.zeros(len(root), bool)
    has_others[tile[~tree]] = True
    queries = np.flatnonzero(~tree | ~has_others[tile])
    queries = queries[weight[tile[queries]] > 0]
    labels = Labels(len(fp))
    cost = np.cumsum(weight[tile[queries]])
    at = 0
    while at < len(queries):
        to = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + FRONTIER, "right")))
        part = queries[at:to]
        for q, node in forest.search(fp[part], root[tile[part]], radius):
            labels.join(part[q], nodes[node])
        at = to
    moved = np.flatnonzero(labels.of != np.arange(len(fp)))
    return fp[moved], fp[labels.of[moved]]


def _search_tiles(radius: int):
    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            key = np.stack([held.column(c).to_numpy() for c in ("t", "k", "lo", "hi")])
            new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if len(new):  # the last tile may go on in the next batch
                yield from emit(held.slice(0, int(new[-1])), key[:, : new[-1]], new[:-1])
                held = held.slice(int(new[-1]))
        if held is not None and held.num_rows:
            key = np.stack([held.column(c).to_numpy() for c in ("t", "k", "lo", "hi")])
            yield from emit(held, key, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1)

    def emit(t, key, new):
        tile = np.zeros(t.num_rows, np.int64)
        tile[new] = 1
        fp = t.column("fp").to_numpy().astype(np.int64)
        a, b = _forest_edges(fp.view(np.uint64), np.cumsum(tile), t.column("c").to_numpy() == key[2], radius)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def block_masks(radius: int, shards: int) -> list[int]:
    """Masks of every choice of (blocks - radius) blocks of the 64 bits, as signed numbers.

    The fewest blocks whose choices hold log2(shards) bits are taken; up to twelve blocks.
    """
    blocks = radius + 1
    while blocks < 12 and 2 ** (64 * (blocks - radius) // blocks) < shards:
        blocks += 1
    edge = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in range(blocks)]
    whole = [sum(one[i] for i in x) for x in combinations(range(blocks), blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in whole]


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Edges (a, b) whose components are those of all links between the distinct fingerprints fps(fp)."""
    masks = block_masks(radius, fps.count() // SHARD)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("t", "k"))
    hot = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where(F.col("n") > tree).select("t", "k", F.ceil(F.col("n") / tree).cast("int").alias("parts"))
    dealt = keyed.join(hot, ["t", "k"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("c", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    tiles = dealt.select("t", "k", "fp", "c", F.explode(F.expr("sequence(0, parts - 1)")).alias("j"))
    tiles = tiles.select("t", "k", F.least("c", "j").alias("lo"), F.greatest("c", "j").alias("hi"), "c", "fp")
    tiles = tiles.repartition("t", "k", "lo", "hi").sortWithinPartitions("t", "k", "lo", "hi", "fp")  # the least of a component stands for it, in all tiles alike
    return tiles.mapInArrow(_search_tiles(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of docs; id_col must be an integer.

    component_id is the smallest id reachable over links of at most `radius` differing bits, the row itself included. Null and empty
    texts have fingerprint zero and link like any other. Rows with equal ids or equal texts stay, each with its class. A null id
    never names a component; if no id of a component is known, component_id is null. An empty table gives an empty result. Other
    columns are not read.
    """
    fps = stored(fingerprints(docs, id_col, text_col, words), "fingerprints", scan=True)
    classes = stored(fps.groupBy("fp").agg(F.min(id_col).alias("rep")), "classes")
    found = connected_components(fingerprint_links(classes.select("fp"), radius)).withColumnsRenamed({"node": "fp", "component": "c"})
    named = stored(classes.join(found, "fp"), "linked")
    least = named.groupBy("c").agg(F.min("rep").alias("least"))
    named = classes.join(named.join(least, "c").select("fp", "least"), "fp", "left").select("fp", F.coalesce("least", "rep").alias("component_id"))
    return fewer(fps.join(named, "fp", "left")).select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", by=near_duplicates, text_col: str = "text", **how) -> DataFrame:
    """The rows of docs whose id names their component; every row without an id stays.

    Of rows with equal ids one stays: that whose text has the least MD5 (null as empty), then the one whose other columns as JSON are
    least, so the choice does not depend on how the rows are dealt.
    """
    keep = by(docs, id_col, **how).where(F.col("component_id") == F.col(id_col)).select(id_col).distinct()
    one = docs.where(F.col(id_col).isNotNull()).join(keep, id_col, "left_semi")
    order = F.struct(F.md5(F.coalesce(text_col, F.lit("")).cast("binary")), F.to_json(F.struct(*docs.drop(text_col).columns)), F.col(text_col).isNull())
    one = one.groupBy(F.col(id_col).alias("_id")).agg(F.min_by(F.struct(*docs.columns), order).alias("_row")).select("_row.*")
    return one.unionByName(docs.where(F.col(id_col).isNull()))


def op1_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op1_simhash_near_dedup": op1_simhash_near_dedup}
ORACLE: dict[str, str] = {}
