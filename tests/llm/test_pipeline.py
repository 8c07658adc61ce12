"""The corpus pipeline, stage by stage and whole, against brute force."""

import hashlib
import re
from itertools import combinations
from math import ceil, exp, sqrt

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import DOCS, WORDS, plain_live, plain_score

import corpus_pipeline as cp
from tallyloom.llm import bpe, mixing, quality

LABELS = "doc_id long, quality int, toxic int"


def corpus():
    """Good and junk texts, exact and near copies at similarities of 0.8 and more, secrets, odd rows, a source of one document."""
    rng = np.random.default_rng(8)
    prose = lambda n: " ".join(rng.choice(WORDS, n)) + "."
    rows = [(i, prose(120), ("de", "en", "es", "fr")[i % 4], f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, "$$ ||| " * 30 + f"### {i} @@ {'|' * (i % 7)}", "en", "s1") for i in range(30)]
    rows += [(200 + i, rows[i][1], "en", "s2") for i in range(8)]
    rows += [(300 + i, rows[i][1] + " " + prose(8 + i), "fr", "s0") for i in range(8)]  # 116 shingles and 8 to 15 more
    rows += [(400, prose(50) + " token=" + "q7" * 9 + " " + prose(60), "en", "only"), (401, None, "en", "s0"), (402, "", None, None), (403, " \n", "en", "s0")]
    rows += [(410 + i, prose(110) + " AKIA" + "E" * 16, lang, "s1") for i, lang in enumerate(("de", "en", "es", "fr"))]
    rows += [(420 + i, prose(110) + " AKIA" + "F" * 16, "en", f"t{i}") for i in range(5)]
    rows += [(430, prose(20_000), "en", "s2"), (None, prose(90), "en", "s1"), (431, prose(90), "en", "s1"), (431, prose(95), "en", "s1")]
    return [(*r[:2], *r[2:], None if r[1] is None else len(r[1])) for r in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(corpus(), DOCS).coalesce(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100), 0) for i in [*range(60), *range(100, 130)]], LABELS).coalesce(1).write.parquet(f"{at}/labels.parquet")
    return str(at)


def plain_quality(spark, docs, folder):
    rows = spark.createDataFrame(docs, DOCS)
    model = quality.train(quality.featurise(rows), spark.read.parquet(f"{folder}/labels.parquet"))
    return [r for r, s in zip(docs, plain_score(model, [quality.features(r.text) for r in docs])) if s >= 0.3]


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_near(docs):
    sets = [shingle_set(r.text) for r in docs]
    of = list(range(len(docs)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, j in combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a == b or 5 * len(a & b) >= 4 * len(a | b) > 0:
            of[root(i)] = root(j)
    least = {}
    for i, r in enumerate(docs):
        if r.doc_id is not None:
            least[root(i)] = min(r.doc_id, least.get(root(i), r.doc_id))
    return [r for i, r in enumerate(docs) if r.doc_id is None or least[root(i)] == r.doc_id]


def plain_redaction(docs):
    out = []
    for r, spans in zip(docs, plain_live(docs)):
        parts, at = [], 0
        for s, e in spans:
            if s > at or not parts:
                parts += [r.text[at:s], "<secret>"]
            at = max(at, e)
        text = None if r.text is None else "".join(parts) + r.text[at:]
        out.append(type(r)(**{**r.asDict(), "text": text, "n_chars": None if text is None else len(text)}))
    return out


def plain_counts(docs):
    n = {}
    for r in docs:
        n[r.source] = n.get(r.source, 0) + 1
    out = []
    for r in docs:
        rate = len(docs) * (sqrt(n[r.source]) / sum(map(sqrt, n.values()))) / n[r.source]
        u = int(hashlib.md5(f"{mixing.SEED}|{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        p, total, copies = exp(-rate), exp(-rate), 0
        for k in range(1, ceil(rate + 10 * sqrt(rate) + 20) + 1):
            copies += total <= u
            p *= rate / k
            total += p
        out.append(copies)
    return out


def rows_of(rows):
    return sorted(map(str, (tuple(r) for r in rows)))


def test_quality_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got, every = cp.reject_low_quality(spark, docs, folder), docs.collect()
    want = plain_quality(spark, every, folder)
    assert rows_of(got.collect()) == rows_of(want) and got.columns == docs.columns
    kept = {r.doc_id for r in want}
    assert set(range(60)) <= kept and not kept & set(range(100, 130))


def test_near_duplicate_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got, want = cp.drop_near_duplicates(spark, docs, folder).collect(), plain_near(docs.collect())
    ids = {r.doc_id for r in got}
    assert ids == {r.doc_id for r in want} and not ids & {*range(200, 208), *range(300, 308)} and None in ids
    assert len(got) == len(ids) and {401, 402, 403} & ids == {401}  # of equal ids, and of texts without words, one stays


def test_secret_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = cp.redact_secrets(spark, docs, folder)
    assert rows_of(got.collect()) == rows_of(plain_redaction(docs.collect())) and got.schema == docs.schema
    text = {r.doc_id: r.text or "" for r in got.collect()}
    assert "q7" not in text[400] and all("AKIA" not in text[410 + i] for i in range(4)) and all("AKIA" in text[420 + i] for i in range(5))
    assert cp.redact_secrets(spark, docs.drop("n_chars"), folder).columns == ["doc_id", "text", "lang", "source"]


def test_mixing_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    every = docs.collect()
    want = [r for r, n in zip(every, plain_counts(every)) for _ in range(n)]
    assert rows_of(cp.mix_sources(spark, docs, folder).collect()) == rows_of(want)
    assert cp.mix_sources(spark, docs.withColumn("copy_no", F.lit(1)), folder).columns == docs.columns


def plain_tokens(docs):
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    path, pattern = bpe.default_vocabulary()
    e = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    ids = [e.encode_ordinary(r.text or "") for r in docs]
    return [(r.doc_id, r.source, x, len(x)) for r, x in zip(docs, ids)]


def test_token_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert rows_of(cp.tokenise(spark, docs, folder).collect()) == rows_of(plain_tokens(docs.collect()))


def one_an_id(docs):
    """Of rows with equal ids that whose text has the least MD5."""
    least = {}
    for r in docs:
        key = hashlib.md5((r.text or "").encode()).hexdigest()
        if r.doc_id not in least or key < least[r.doc_id][0]:
            least[r.doc_id] = (key, r)
    return [r for r in docs if r.doc_id is None or r is least[r.doc_id][1]]


def test_whole_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = one_an_id(plain_near(plain_quality(spark, docs, folder)))
    got = cp.run(spark, folder).collect()
    redacted = plain_redaction(want)
    expected = [r for r, c in zip(redacted, plain_counts(redacted)) for _ in range(c)]
    assert rows_of(got) == rows_of(plain_tokens(expected))


def test_stages_of_an_empty_table(spark, folder):
    none = spark.createDataFrame([], DOCS)
    for _, stage in cp.STAGES:
        assert stage(spark, none, folder).count() == 0


def test_stages_with_clashing_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 40")
    odd = docs.withColumns({"label": F.lit("x"), "component_id": F.lit(1), "live": F.lit(2), "key": F.lit(3), "id": F.lit(4), "hash": F.lit(5), "token_ids": F.lit(6), "d": F.lit(7), "text_hash": F.lit(8)})
    for _, stage in cp.STAGES[:-1]:
        plain, got = stage(spark, docs, folder), stage(spark, odd, folder)
        assert rows_of(got.select(docs.columns).collect()) == rows_of(plain.collect()) and got.columns == odd.columns
    assert rows_of(cp.tokenise(spark, odd, folder).collect()) == rows_of(cp.tokenise(spark, docs, folder).collect())
