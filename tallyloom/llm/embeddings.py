"""Embedding near-duplicates by sorted projection passes.

Each pass gives a vector SYMBOLS random hashes, each the largest of DIRECTIONS random projections and its sign, orders the vectors of a
label lexicographically by them, and compares each with the WINDOW before it; pairs found are checked by cosine. Large labels are hashed
relative to their mean, so that a direction all their vectors share tells them apart no worse.

How many passes a vector needs is measured, not assumed: a partner at the threshold is missed by a pass only if it shares fewer hashes
than the row next to the window does, and the chance of that follows from the hashes' known collision chance. Vectors for which all
passes together could miss a partner with a chance above MISS go on to further passes with windows twice as wide. After ROUNDS rounds,
or once at most REST of a label's vectors are left, those left are compared with one another in blocks, so nothing rests on luck alone.

The passes' spanning forests are united into components. Links are then counted exactly inside each component: vectors within half the
threshold's angle of the component's first vector are all linked with one another, so they are counted and not compared, and only the
others meet the component's vectors, in blocks. Equal vectors are one class with a weight.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import hot_keys, join_skewed, stored, table
from tallyloom.llm.components import connected_components
from tallyloom.llm.simhash import Labels

THRESHOLD, WINDOW, SEED = 0.93, 64, 11
#: Random directions behind a hash, and hashes in a sort key, eight bits each.
DIRECTIONS, SYMBOLS = 64, 6
#: Chance that all passes miss a partner at the threshold; passes sorted by one job, which is a round; rounds; vectors in a block.
MISS, PASSES_A_JOB, ROUNDS, BLOCK = 0.002, 3, 8, 1024
#: Vectors of a label that are compared in blocks at once when so few are left after a round.
REST = 4096


def _symbols(y: np.ndarray) -> np.ndarray:
    """The place of the largest projection by size, doubled, plus its sign."""
    at = np.abs(y).argmax(axis=1)
    return 2 * at + (y[np.arange(len(y)), at] > 0)


@lru_cache(maxsize=1)
def agreement() -> tuple[np.ndarray, np.ndarray]:
    """Cosines, and the chance that two vectors at each of them share a hash, from 8,000 draws."""
    u, v = np.random.default_rng(SEED).standard_normal((2, 8000, DIRECTIONS))
    cosines = np.linspace(0, 1, 41)
    chance = [(_symbols(u) == _symbols(c * u + math.sqrt(1 - c * c) * v)).mean() for c in cosines]
    return cosines, np.maximum.accumulate(np.maximum(chance, 0.5 / DIRECTIONS))


def _units(raw: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, without overflow."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def prepare(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(row, id, label, vec, key): vec holds the components as bytes, or null if the vector or its label can't link; key names equal vectors of a label."""
    single = isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"

    def bytes_of(x):
        x = np.array(x, kind)
        return (x + x.dtype.type(0)).tobytes() if np.isfinite(x).all() and x.any() else None

    def run(batches):
        for b in batches:
            v = b.column(3)
            flat, ends = v.flatten(), np.diff(v.offsets.to_numpy())
            if v.null_count or flat.null_count or not len(ends) or ends.min() != ends.max() or not ends[0]:
                out = [bytes_of(x) if (x := y.as_py()) and None not in x else None for y in v]
            else:
                x = flat.to_numpy().astype(kind).reshape(len(ends), -1)
                ok = np.isfinite(x).all(axis=1) & x.any(axis=1)
                out = [y.tobytes() if fine else None for y, fine in zip(x + x.dtype.type(0), ok)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.binary())], ["row", "id", "label", "vec"])

    types = {c: vectors.schema[c].dataType.simpleString() for c in (id_col, label_col)}
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    rows = rows.mapInArrow(run, f"row long, id {types[id_col]}, label {types[label_col]}, vec binary")
    rows = rows.withColumn("vec", F.when(F.col("label").isNotNull(), F.col("vec")))
    return rows.withColumn("key", F.unhex(F.md5("vec")))


def _matrix(vecs: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows, shorter ones filled up with zeros, and their true widths."""
    raw = [np.frombuffer(v.as_py(), kind) for v in vecs]
    width = np.array([len(v) for v in raw])
    x = np.zeros((len(raw), max(width, default=0)))
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        x[at, :w] = _units(np.stack([raw[i] for i in at]))
    return x, width


def label_means(nodes: DataFrame, kind: str) -> dict[tuple[int, int], np.ndarray]:
    """The mean unit vector by (label, width) of the labels with more than one in HOT of all vectors: fewer than HOT of them."""

    def run(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            g = b.column(0).to_numpy()
            x, width = _matrix(b.column(1), kind)
            for key in set(zip(g.tolist(), width.tolist())):
                part = x[(g == key[0]) & (width == key[1]), : key[1]]
                sums[key] = sums.get(key, 0) + np.append(part.sum(axis=0), len(part))
        for (label, w), row in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([label], pa.int64()), pa.array([w], pa.int64()), pa.array([row], pa.list_(pa.float64()))], ["g", "w", "sums"])

    large = hot_keys(nodes.groupBy("g").agg(F.count("*").alias("n")), ["g"])
    parts = nodes.join(F.broadcast(large), "g").select("g", "vec").mapInArrow(run, "g long, w long, sums array<double>")
    sums = parts.select("g", "w", F.posexplode("sums").alias("i", "x")).groupBy("g", "w", "i").agg(F.sum("x").alias("x"))
    sums = sums.groupBy("g", "w").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).collect()
    return {(r.g, r.w): np.array([e.x for e in r.v[:-1]]) / r.v[-1].x for r in sums}


def _with_keys(rows: DataFrame, kind: str, passes: range, means: dict, threshold: float) -> DataFrame:
    """rows(node, g, vec), once a pass, with the pass's sort key and the chance that a partner at the threshold shares a hash."""
    apart = 2 - 2 * threshold  # squared distance of such a pair

    def run(batches):
        cosines, chance = agreement()
        for b in batches:
            x, width = _matrix(b.column(2), kind)
            g = b.column(1).to_numpy()
            keys, share = np.zeros((len(x), len(passes)), np.int64), np.zeros(len(x))
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                r = x[at, :w]
                for label in np.unique(g[at]):
                    if (mean := means.get((int(label), int(w)))) is not None:
                        r[g[at] == label] -= mean
                square = np.maximum((r * r).sum(axis=1), 1e-12)
                share[at] = np.interp(np.sqrt(np.maximum(0, 1 - apart / square)), cosines, chance)
                for k, p in enumerate(passes):
                    for hashes in np.random.default_rng([SEED, p, int(w)]).standard_normal((SYMBOLS, w, DIRECTIONS)):
                        keys[at, k] = keys[at, k] << 8 | _symbols(r @ hashes)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(keys), pa.list_(pa.int64())), pa.array(share)], ["node", "g", "vec", "keys", "share"])

    keyed = rows.select("node", "g", "vec").mapInArrow(run, "node long, g long, vec binary, keys array<long>, share double")
    return keyed.select("node", "g", "vec", "share", F.posexplode("keys").alias("pass", "key"))


def _linked(x: np.ndarray, may, rows: range, columns: range, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices (row, column) of the pairs that `may` link and reach the threshold."""
    i, j = np.arange(rows.start, rows.stop), np.arange(columns.start, columns.stop)
    a, b = np.nonzero((x[i] @ x[j].T >= threshold) & may(i[:, None], j))
    return i[a], j[b]


def _windows(kind: str, threshold: float, window: int):
    """Of sorted rows: forest edges (a, b) of the verified pairs, each row compared with the `window` rows before it; and (a, null, miss) for
    each row, the logarithm of the chance that the pass missed a partner. Beyond a partition's ends nothing is known, which counts as missed."""

    def emit(t, start, stop):
        g, p, key, node, share = (t.column(c).to_numpy() for c in ("g", "pass", "key", "node", "share"))
        x, width = _matrix(t.column("vec").combine_chunks(), kind)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        may = lambda i, j: (j < i) & (i - j <= window) & (g[i] == g[j]) & (p[i] == p[j]) & (width[i] == width[j])
        for at in range(start, stop, 256):
            to = min(at + 256, stop)
            i, j = _linked(x, may, range(at, to), range(max(0, at - window), to), threshold)
            a.append(i)
            b.append(j)
        labels = Labels(len(x))
        labels.join(np.concatenate(a), np.concatenate(b))
        moved = np.flatnonzero(labels.of != np.arange(len(x)))

        def shared(i, j):
            like = sum(((key[i] ^ key[j]) >> 8 * k == 0).astype(int) for k in range(SYMBOLS))
            return np.where((g[i] == g[j]) & (p[i] == p[j]), like, -1)

        i = np.arange(start, stop)
        depth = np.maximum(shared(i, np.maximum(i - window - 1, 0)), shared(i, np.minimum(i + window + 1, len(x) - 1)))
        miss = np.log1p(-np.minimum(share[i] ** (depth + 1), 1 - 1e-12))
        ends = [pa.array(np.concatenate([node[moved], node[i]])), pa.array([*node[labels.of[moved]].tolist(), *[None] * len(i)], pa.int64())]
        return pa.RecordBatch.from_arrays([*ends, pa.array([*[None] * len(moved), *miss.tolist()], pa.float64())], ["a", "b", "miss"])

    def run(batches):
        held, start = None, 0
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            while (stop := min(start + 2 * window + 4096, held.num_rows - window - 1)) - start >= 4096:
                yield emit(held.slice(0, stop + window + 1), start, stop)
                cut = max(0, stop - window - 1)
                held, start = held.slice(cut), stop - cut
        if held is not None and held.num_rows > start:
            yield emit(held, start, held.num_rows)

    return run


def _by_tile(keys: tuple[str, ...], made):
    """made(rows) for every run of rows with equal keys."""

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            key = np.stack([held.column(c).to_numpy() for c in keys])
            new = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist()]
            for a, z in zip(new, new[1:]):
                yield made(held.slice(a, z - a))
            held = held.slice(new[-1])
        if held is not None and held.num_rows:
            yield made(held)

    return run


def block_links(rows: DataFrame, kind: str, threshold: float) -> DataFrame:
    """Forest edges (a, b) of all pairs of rows(node, g, vec) of one label at the threshold: the label's rows are dealt to blocks, and every two blocks are a tile."""

    def compare(t):
        c, lo, hi, node = (t.column(k).to_numpy() for k in ("c", "lo", "hi", "node"))
        x, width = _matrix(t.column("vec").combine_chunks(), kind)
        first, second = np.flatnonzero(c == lo), np.flatnonzero(c == hi)
        i, j = np.nonzero((x[first] @ x[second].T >= threshold) & (width[first][:, None] == width[second]))
        labels = Labels(len(x))
        labels.join(first[i], second[j])
        moved = np.flatnonzero(labels.of != np.arange(len(x)))
        return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[labels.of[moved]])], ["a", "b"])

    sizes = stored(rows.groupBy("g").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    parts = sizes.select("g", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    dealt = join_skewed(rows, parts, ["g"], hot_keys(sizes, ["g"])).withColumn("c", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    tiles = dealt.select("g", "node", "vec", "c", F.explode(F.expr("sequence(0, parts - 1)")).alias("j"))
    tiles = tiles.select("g", F.least("c", "j").alias("lo"), F.greatest("c", "j").alias("hi"), "c", "node", "vec")
    return tiles.repartition("g", "lo", "hi").sortWithinPartitions("g", "lo", "hi").mapInArrow(_by_tile(("g", "lo", "hi"), compare), "a long, b long")


def projection_links(nodes: DataFrame, kind: str, threshold: float = THRESHOLD, window: int = WINDOW, rounds: int = ROUNDS, rest: int = REST) -> DataFrame:
    """Edges (a, b) of nodes(node, label, vec): the pairs found in all passes, and in blocks for what the passes leave.

    Ties within a pass are put in a new order by each pass.
    """
    nodes = nodes.select("node", F.xxhash64("label").alias("g"), "vec")
    means = label_means(nodes, kind)
    active, edges, missed = nodes, [], None
    for r in range(rounds):
        passes = range(r * PASSES_A_JOB, (r + 1) * PASSES_A_JOB)
        keyed = _with_keys(active, kind, passes, means, threshold).withColumn("tie", F.xxhash64("node", "pass", F.lit(r)))
        order = ["pass", "g", "key", "tie"]
        found = keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_windows(kind, threshold, window << r), "a long, b long, miss double")
        found = stored(found, "pairs")
        edges.append(found.where("b IS NOT NULL").select("a", "b"))
        now = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("miss").alias("miss"))
        if missed is not None:
            now = now.join(missed.withColumnRenamed("miss", "before"), "node").select("node", (F.col("miss") + F.col("before")).alias("miss"))
        missed = stored(now.where(F.col("miss") > math.log(MISS)), "missed")
        left = active.join(missed.select("node"), "node", "left_semi")
        sizes = stored(left.groupBy("g").agg(F.count("*").alias("n")), "sizes")
        few = sizes.where(F.col("n") <= rest) if r + 1 < rounds else sizes
        ended, every = few.count(), sizes.count()
        left = stored(left, "left") if every else left
        if ended:
            edges.append(stored(block_links(left.join(few.select("g"), "g", "left_semi"), kind, threshold), "pairs"))
        if ended == every:
            break
        active = left.join(few.select("g"), "g", "left_anti")
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


def _tiles(kind: str, threshold: float):
    """(node, n): weights of the linked vectors, between each tile's outer vectors (side 0) and the component's (side 1)."""

    def count(t):
        side, node, m, core = (t.column(c).to_numpy(zero_copy_only=False) for c in ("side", "node", "m", "core"))
        x, width = _matrix(t.column("vec").combine_chunks(), kind)
        r, s = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        like = (x[r] @ x[s].T >= threshold) & (node[r][:, None] != node[s]) & (width[r][:, None] == width[s])
        mine, inner = like @ m[s], core[s]
        theirs = (like.T @ m[r])[inner]  # outer vectors are counted from their own side
        n = np.concatenate([mine, theirs])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([node[r], node[s][inner]])), pa.array(n.astype(np.int64))], ["node", "n"])

    return _by_tile(("c", "i", "j"), count)


def _similarity_to_first(kind: str):
    def run(batches):
        for b in batches:
            x, _ = _matrix(b.column(2), kind)
            y, _ = _matrix(b.column(3), kind)
            d = max(x.shape[1], y.shape[1])
            pad = lambda z: np.pad(z, ((0, 0), (0, d - z.shape[1])))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], b.column(4), pa.array(np.einsum("ij,ij->i", pad(x), pad(y)))], ["c", "node", "vec", "m", "cos"])

    return run


def count_links(members: DataFrame, kind: str, threshold: float = THRESHOLD) -> DataFrame:
    """(node, n): for members(c, node, vec, m) of components c, the weight of the other nodes linked with each. Exact within a component."""
    rows = stored(members.select("c", "node", "vec", "m"), "members")
    whole = stored(rows.groupBy("c").agg(F.count("*").alias("n")), "sizes")
    hot = hot_keys(whole, ["c"])
    first = rows.where("c = node").select("c", F.col("vec").alias("first"))
    rows = join_skewed(rows, first, ["c"], hot).select("c", "node", "vec", "first", "m")
    near = math.cos(math.acos(threshold) / 2) + 1e-9
    rows = rows.mapInArrow(_similarity_to_first(kind), "c long, node long, vec binary, m long, cos double")
    rows = stored(rows.select("c", "node", "vec", "m", (F.col("cos") >= near).alias("core")), "members")
    sizes = rows.groupBy("c").agg(F.count("*").alias("n"), F.sum(F.when(F.col("core"), F.col("m"))).alias("w"), F.count_if(~F.col("core")).alias("outer"))
    sizes = stored(sizes, "sizes")
    inner = join_skewed(rows.where("core").select("c", "node", "m"), sizes.select("c", "w"), ["c"], hot).select("node", (F.col("w") - F.col("m")).alias("n"))
    blocks = sizes.where("outer > 0").select("c", F.ceil(F.col("outer") / BLOCK).cast("int").alias("outer"), F.ceil(F.col("n") / BLOCK).cast("int").alias("all"))
    dealt = join_skewed(rows, blocks, ["c"], hot)
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    outer = dealt.where("NOT core").select("c", place("outer").alias("i"), every("all").alias("j"), F.lit(0).alias("side"), "node", "vec", "m", "core")
    every_one = dealt.select("c", every("outer").alias("i"), place("all").alias("j"), F.lit(1).alias("side"), "node", "vec", "m", "core")
    tiles = outer.unionByName(every_one).repartition("c", "i", "j").sortWithinPartitions("c", "i", "j")
    return inner.unionByName(tiles.mapInArrow(_tiles(kind, threshold), "node long, n long")).groupBy("node").agg(F.sum("n").alias("n"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, **how) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row.

    Vectors link if their labels are equal and not null, their lengths are equal, and their cosine in double precision reaches the
    threshold. Null or zero vectors, and those with null or non-finite components, link with nothing and form components of their own.
    Rows with equal ids are vectors of their own. A null id never names a component; its row is not kept. Other columns are not read.
    """
    kind = "<f4" if isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType) else "<f8"
    rows = stored(prepare(vectors, id_col, vec_col, label_col), "vectors", scan=True)
    nodes = rows.where("vec IS NOT NULL").groupBy("label", "key").agg(F.min("row").alias("node"), F.count("*").alias("m"), F.min("id").alias("least"), F.first("vec").alias("vec"))
    nodes = stored(nodes, "nodes")
    found = stored(connected_components(projection_links(nodes, kind, threshold, **how)).withColumnRenamed("component", "c"), "components")
    links = count_links(nodes.select("node", "vec", "m").join(found, "node"), kind, threshold)
    named = nodes.select("node", "least").join(found, "node")
    least = stored(named.groupBy("c").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "least")
    named = join_skewed(named.select("c", "node"), least.drop("n"), ["c"], hot_keys(least, ["c"]))
    classes = nodes.drop("vec").join(named.drop("c"), "node", "left").join(links, "node", "left")
    classes = classes.select("label", "key", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    some = join_skewed(rows.where("vec IS NOT NULL").select("id", "label", "key"), classes, ["label", "key"], hot_keys(nodes, ["label", "key"], "m"))
    none = rows.where("vec IS NULL").select("id", F.lit(0).alias("n_links"), F.col("id").alias("component_id"))
    out = some.select("id", "n_links", "component_id").unionByName(none)
    out = out.select(F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def op8_embedding_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op8_embedding_near_dedup": op8_embedding_near_dedup}
ORACLE = {
    "op8_embedding_near_dedup": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) c ON c.a = vec_id LEFT JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) d ON d.a = vec_id"""
}
