"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting goes round the features one by one; each step fits a shallow tree to one feature's binned gradients and adds it to that
feature's lookup table. Then the pairs with the most left to explain get tables of two binned features. A score is a sum of
looked-up bins. Features are taken from the text alone, on the executors; the model is fitted on at most SAMPLE labelled rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored, table, text_or_empty

#: At most so many labelled rows, chosen by a hash of their ids, are fitted on; scores are for all rows.
SAMPLE = 20_000
FOLDS, THRESHOLD = 5, 0.3
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE, LEAVES, RIDGE = 32, 8, 8, 150, 60, 0.1, 4, 1.0

FEATURES = (
    "log_bytes", "log_words", "word_length", "longest_word", "upper", "digits", "stops", "symbols", "bars", "exclaims", "wide_bytes",
    "word_variety", "top_word", "repeated_next", "short_words", "symbol_ends", "log_lines", "line_variety", "ended_lines", "upper_words",
)
_UPPER, _DIGITS, _STOPS, _SYMBOLS = (bytes(range(65, 91)), b"0123456789", b".,;:?'\"", b"#$%&*|<>{}[]=+~^_\\/@")
_ENDED = (".", "!", "?", "。")


def features(text: str | None) -> list[float]:
    """The features of one whole text; null counts as empty."""
    t = text or ""
    raw = t.encode("utf-8", "surrogatepass")
    words, lines = t.split(), t.split("\n")
    n, m = max(1, len(raw)), max(1, len(words))
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / n
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    return [
        math.log1p(len(raw)), math.log1p(len(words)), sum(map(len, words)) / m, math.log1p(max(map(len, words), default=0)), share(_UPPER), share(_DIGITS), share(_STOPS), share(_SYMBOLS), share(b"|"), share(b"!"), 1 - len(raw.decode("utf-8", "ignore").encode("ascii", "ignore")) / n,
        math.log1p(len(counts)) / math.log1p(m), max(counts.values(), default=0) / m, sum(map(str.__eq__, words, words[1:])) / m, sum(len(w) == 1 for w in words) / m, sum(1 for w in words if w[-1] in "#$%&*|") / m, math.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), sum(x.rstrip().endswith(_ENDED) for x in lines) / max(1, len(lines)), sum(map(str.isupper, words)) / m,
    ]


def featurise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, one double a feature) of every row."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{f} double" for f in FEATURES)

    def run(batches):
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(1)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, np.ascontiguousarray(x.T))], ["id", *FEATURES])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


@dataclass
class AdditiveModel:
    """base + a looked-up value for each feature's bin + one for each pair's two bins."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            out += t[np.searchsorted(e, x[:, j], "right")]
        bins = {j: np.searchsorted(self.pair_edges[j], x[:, j], "right") for j in {j for p in self.pairs for j in p}}
        for (i, j), t in self.pairs.items():
            out += t[bins[i], bins[j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins; place 0: none."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    left, right = cg[:-1], cg[-1] - cg[:-1]
    gain = left**2 / (ch[:-1] + RIDGE) + right**2 / (ch[-1] - ch[:-1] + RIDGE) - cg[-1] ** 2 / (ch[-1] + RIDGE)
    if not len(gain):
        return 0.0, 0
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Leaf values, one a bin, of a shallow tree grown best cut first."""
    runs = [(0, len(g))]
    cuts = [_split(g, h)]
    while len(runs) < leaves:
        i = max(range(len(runs)), key=lambda k: cuts[k][0])
        if cuts[i][0] <= 1e-9:
            break
        (a, b), at = runs[i], runs[i][0] + cuts[i][1]
        runs[i : i + 1] = [(a, at), (at, b)]
        cuts[i : i + 1] = [_split(g[a:at], h[a:at]), _split(g[at:b], h[at:b])]
    out = np.empty(len(g))
    for a, b in runs:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of a tree that cuts the first feature once, then the second once on either side."""
    _, at = _split(g.sum(axis=1), h.sum(axis=1))
    out, gain = np.empty_like(g), -(g.sum() ** 2) / (h.sum() + RIDGE)
    for rows in (slice(0, at), slice(at, None)) if at else (slice(None),):
        values = _tree(g[rows].sum(axis=0), h[rows].sum(axis=0), 2)
        out[rows] = values
        for v in np.unique(values):
            k = values == v
            gain += g[rows][:, k].sum() ** 2 / (h[rows][:, k].sum() + RIDGE)
    return gain, out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Without rows, or with one class only, the model is the smoothed share of label 1."""
    p = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(math.log(p / (1 - p)), [np.zeros(0)] * x.shape[1], [np.zeros(1)] * x.shape[1])
    if len(np.unique(y)) < 2:
        return model
    model.edges, model.pair_edges = _edges(x, BINS), _edges(x, PAIR_BINS)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    f = np.full(len(y), model.base)

    def slopes(f):
        p = 1 / (1 + np.exp(-f))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            g, h = slopes(f)
            n = len(model.tables[j])
            step = RATE * _tree(np.bincount(b, g, n), np.bincount(b, h, n))
            model.tables[j] += step
            f += step[b]
    wide = [len(e) + 1 for e in model.pair_edges]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]
    code = lambda i, j: bins[i] * wide[j] + bins[j]

    def grid(i, j, of):
        return np.bincount(code(i, j), of, wide[i] * wide[j]).reshape(wide[i], wide[j])

    g, h = slopes(f)
    gains = {(i, j): _pair_tree(grid(i, j, g), grid(i, j, h))[0] for i, j in combinations(range(x.shape[1]), 2)}
    best = sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS]
    model.pairs = {k: np.zeros((wide[k[0]], wide[k[1]])) for k in best}
    for _ in range(PAIR_ROUNDS):
        for i, j in best:
            g, h = slopes(f)
            step = RATE * _pair_tree(grid(i, j, g), grid(i, j, h))[1]
            model.pairs[i, j] += step
            f += step.ravel()[code(i, j)]
    return model


def held_out(id_col: str):
    """Rows whose crc32 of the id as text is divisible by FOLDS are never learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learnable(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """(id_col, _label) of about 1.2 times `sample` labelled ids outside the held-out fold, chosen by hash; of several labels of an id the largest counts."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(id_col).agg(F.max(label_col).cast("double").alias("_label"))
    share = min(1.0, 1.2 * sample / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))


def train(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> AdditiveModel:
    """Fits on at most `sample` labelled rows outside the held-out fold. Null ids and labels are left out.

    Of rows with equal ids the one with the least features counts, so the same tables give the same model.
    """
    rows = feats.join(learnable(labels, id_col, label_col, sample), id_col).groupBy(id_col, "_label").agg(F.min(F.struct(*FEATURES)).alias("x"))
    rows = rows.orderBy(F.xxhash64(id_col), id_col).limit(sample).select("_label", "x.*").toPandas().to_numpy(float)
    return fit(rows[:, 1:], rows[:, 0])


def score_features(feats: DataFrame, model: AdditiveModel, id_col: str = "doc_id") -> DataFrame:
    kind = feats.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]], axis=1) if b.num_rows else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], ["id", "score"])

    return feats.select(F.col(id_col).alias("id"), *FEATURES).mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id_col, held_out, score, predicted) for every row of docs, empty and null texts included. Equal texts get equal scores.

    Only the text is looked at: other columns are not read. Without usable labels every score is the smoothed share, 0.5.
    """
    feats = stored(featurise(docs, id_col, text_col), "features", scan=True)
    out = score_features(feats, train(feats, labels, id_col, **how), id_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def accept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs that the classifier, fitted on docs and labels, does not reject.

    A null text counts as empty, and every row is judged by itself, whole, so ids may repeat or be null; an empty table gives an empty
    result, and without usable labels all rows stay. To fit, features are taken of the labelled sample only, at most SAMPLE ids and a
    fifth more, whose number bounds what is broadcast; texts are never shuffled.
    """
    known = stored(learnable(labels, id_col, **how), "labels")
    some = docs.join(F.broadcast(known.select(id_col)), id_col, "left_semi")
    model = train(stored(featurise(some, id_col, text_col), "features", scan=True), labels, id_col, **how)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))))

    return docs.where(scored(text_or_empty(text_col)) >= THRESHOLD)


def op5_quality_classifier(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op5_quality_classifier": op5_quality_classifier}
ORACLE: dict[str, str] = {}
