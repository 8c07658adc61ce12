"""Token counts, alignment of two tokenizers and periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import align, queries, runs, segments, tokens

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, n_tokens string, _key int"
ODD = ["", None, " ", "  ", "\n", " \t\n", "a ", " a", "a  b   c", "word", "word", "▁", "a▁b ▁▁ c", "<s> </s> <unk> <0x0A>", "<|endoftext|> x", "é x　y  z", "a\x1c b\x1d\x1e!\x1f?",
       "don't 's", "漢字かな交じり文。" * 3, "😀🏽 x", "a\r\n b\r\n\r\nc", "x" * 300, "12345 678 a1b2", "\x00a\x00", "ﬁ Å Å", "a﻿b", "…  …", "tab\there\v\fthere"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    words = "the of and token tokens Tokenizer, \"quoted\" (x) 3.14 naïve straße 漢字 foo_bar http://a.b/c?d=e".split()
    long = [" ".join(rng.choice(words) for _ in range(n)) for n in (5, 60, 700)]
    texts = [*ODD, *long, long[1], long[2] + "\n\n" + long[1], "alpha beta gamma\n" * 9_000 + "x"]
    rows = [(i if i % 7 else None, t, "en", "clash", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS), texts


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path(align.BYTE_LEVEL))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path(align.PIECES))


TEXT = st.text(max_size=40) | st.text(alphabet="ab'sT  \n\t\r▁.,1é漢 \x1c ", max_size=40)


# --- token counts


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_pieces_add_up_to_the_library_s_count(library, text):
    text = text.encode("utf-8", "ignore").decode()
    m = tokens.model(tokens.default_vocabulary())
    if text:
        parts = [p for pieces, _ in m.blocks([(0, text)]) for p in pieces.to_pylist()]
        assert "".join(parts) == f" {text}".replace("▁", " ") and sum(m.count(parts)) == len(library[1].encode(text))


@pytest.mark.parametrize("block", [1, 7, 50])
def test_long_texts_are_cut_in_blocks(monkeypatch, block):
    """Pieces and their texts are the same, wherever blocks end."""
    m = tokens.model(tokens.default_vocabulary())
    texts = ["", "a", "word  and words, 12 漢字é\n" * 9, "x" * 200, " ", "é" * 30 + "1"]

    def cut():  # a long text comes before shorter ones that wait
        return sorted(((o, p) for pieces, of in m.blocks(enumerate(texts)) for o, p in zip(of.tolist(), pieces.to_pylist())), key=lambda x: x[0])

    whole = cut()
    monkeypatch.setattr(tokens, "BLOCK", block)
    assert cut() == whole


def test_token_counts(spark, docs, library, monkeypatch):
    """All pieces common, and none."""
    rows, texts = docs
    want = sorted((t is None, len((t or "").encode()), len(library[1].encode(t or ""))) for t in texts)
    for most in (segments.OFTEN, 3):
        monkeypatch.setattr(segments.often, "__defaults__", (most,))
        got = tokens.token_counts(rows.withColumn("missing", F.col("text").isNull()), limit=500)
        assert got.columns == ["doc_id", "lang", "missing", "n_bytes", "n_tokens", "over_limit"]
        got = got.collect()
        assert sorted((r.missing, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 500) for r in got) and any(r.over_limit for r in got)
    assert tokens.token_counts(rows.limit(0)).count() == 0


def test_token_counts_query(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op11_token_counts"](spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        n = len(library[1].encode(r.text or ""))
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_bytes, got[r.doc_id].over_limit) == (n, len((r.text or "").encode()), n > 4096)


def test_often_is_bounded(spark):
    table = spark.range(1, 5001).select(F.col("id").cast("string").alias("piece"), (F.lit(100_000) / F.col("id")).cast("long").alias("n"))
    for most in (0, 1, 10, 400, 5000):
        n = segments.often(table, most).count()
        assert n <= most and n >= 0.9 * most - 1
    assert segments.often(table.limit(0)).count() == 0


# --- alignment


def plain_tokens(library, text):
    """(ids of A, ids of B, their byte strings), or None where they do not give the text back."""
    if not text:
        return None
    al = align.aligner(*align.default_vocabularies())
    a, b = library[0].encode(f" {text}", add_special_tokens=False).ids, library[1].encode(text)
    raw = f" {text}".encode()
    size_a, size_b = [al.a_bytes[x] for x in a], [al.b_bytes[x] for x in b]
    return (a, b, size_a, size_b) if b"".join(size_a) == raw == b"".join(size_b) else None


def spans(ids, sizes):
    ends = np.cumsum([len(x) for x in sizes]).tolist()
    return list(zip([0, *ends], ends, ids))


def plain_alignment(library, texts):
    every = [plain_tokens(library, t) for t in texts]
    linked, out = [], []
    for x in every:
        a, b = (spans(x[0], x[2]), spans(x[1], x[3])) if x else ([], [])
        links, first = [], 0
        for s, e, i in a:
            while first < len(b) and b[first][1] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][0] < e:
                links.append((i, b[k][2]))
                k += 1
        linked.append(links)
    count = {}
    for links in linked:
        for p in set(links):
            count[p] = count.get(p, 0) + 1
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    for x, links in zip(every, linked):
        if x is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = spans(x[0], x[2]), spans(x[1], x[3])
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups = [([], []) for _ in cuts]
        for side, of in enumerate((a, b)):
            for (_, _, i), k in zip(of, np.searchsorted(np.array(cuts), [e for _, e, _ in of])):
                groups[k][side].append(str(i))
        text = ";".join(f"{','.join(g)}|{','.join(h)}" for g, h in groups)
        out.append((len(a), len(b), len(cuts), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_segments_have_the_text_s_tokens(library, text):
    text = text.encode("utf-8", "ignore").decode()
    al = align.aligner(*align.default_vocabularies())
    parts = al.words(text)
    assert "".join(parts) == f" {text}"
    if text:
        found = al.align(parts)
        assert [i for p in parts for i in al.a.encode(p, add_special_tokens=False).ids] == library[0].encode(f" {text}", add_special_tokens=False).ids
        if "▁" not in text:  # such a text has no tokens here
            assert [i for p in parts for i in al.b.encode(f"\n{p}")[al.before :]] == library[1].encode(text)
        assert all(found) == (plain_tokens(library, text) is not None)


NEW = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def test_alignment(spark, docs, library, monkeypatch):
    """All segments frequent, and few; tasks that send on what they gathered."""
    rows, texts = docs
    want = sorted(plain_alignment(library, texts))
    assert sum(w[0] > 0 for w in want) > 20 and (0, 0, 0, 0, 0, 0, "") in want
    for most, gathered in ((segments.OFTEN, align.GATHERED), (3, 50)):
        monkeypatch.setattr(segments.often, "__defaults__", (most,))
        monkeypatch.setattr(align, "GATHERED", gathered)
        got = align.align_tokens(rows.withColumn("n_best", F.lit("clash")))
        assert got.columns == ["doc_id", "lang", "n_tokens", *NEW]
        assert sorted(tuple(r[c] for c in NEW) for r in got.collect()) == want
    assert align.align_tokens(rows.limit(0)).count() == 0


def test_alignment_query(spark, library):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    want = plain_alignment(library, [r.text for r in rows])
    got = {r.doc_id: tuple(r[c] for c in NEW) for r in queries.QUERIES["op12_token_alignment"](spark, FOLDER).collect()}
    assert got == {r.doc_id: w for r, w in zip(rows, want)}


# --- periodic runs


def plain_runs(words):
    """(start, length, period) by the definition: all stretches that are maximal for a period, of which the smallest counts."""
    best, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def plain_result(words):
    found = plain_runs(words)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    return (len(found), *top, top[1] and 1000 * top[1] // top[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


FIELDS = [f.split()[0] for f in runs.FIELDS.split(", ")]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("aab"), max_size=40) | st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=7), st.integers(1, 9), st.lists(st.sampled_from("abc"), max_size=9)).map(lambda x: x[2] + x[0] * x[1] + x[0][:2] + x[2]), max_size=5))
def test_runs_by_the_definition(docs_of_words):
    got = runs._described([[w.encode() for w in d] for d in docs_of_words])
    for d, g in zip(docs_of_words, got):
        want = plain_result(d)
        assert g[:6] == want[:6] and hashlib.sha256(g[6]).hexdigest() == want[6]


def test_periodic_runs(spark, monkeypatch):
    rng = random.Random(0)
    texts = [None, "", " \n", "a", "a " * 5, "a " * 6, "x y " * 3 + "x", "x y\tx y z " * 9, "A a " * 4, "é " * 7 + "b " * 8, "a b " * 5 + "a b c " * 5 + "c " * 20]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(n)) + " q r s t" * k for n, k in ((50, 4), (900, 60), (3, 3))]
    texts += [" ".join(f"w{i % 700}" for i in range(3000)), texts[-1], "lorem ipsum dolor\n" * 60_000]
    rows = spark.createDataFrame([(i % 9, t, "clash", i) for i, t in enumerate(texts)], "doc_id long, text string, n_runs string, row int")
    for size in (runs.BATCH, 40):
        monkeypatch.setattr(runs, "BATCH", size)
        got = {r.row: r for r in runs.periodic_runs(rows).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts[:-1]):
            assert tuple(got[i][f] for f in FIELDS) == plain_result(split(t)), i
        assert (got[len(texts) - 1].n_runs, got[len(texts) - 1].length, got[len(texts) - 1].period) == (1, 180_000, 3)
    kept = {r.row: r.text for r in runs.periodic_runs(rows, collapse=True).collect()}
    assert kept[0] is None and kept[5] == "a" and kept[len(texts) - 1] == "lorem ipsum dolor" and kept[6] == "x y x y x y x"
    assert runs.periodic_runs(rows.limit(0)).count() == 0 and runs.periodic_runs(rows.limit(0), collapse=True).count() == 0


def test_periodic_runs_query(spark):
    got = {r.doc_id: tuple(r[f] for f in FIELDS) for r in queries.QUERIES["op13_periodic_runs"](spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    changed = 0
    for r in rows:
        words = split(r.text)
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            changed += 1
        if n <= 2500:  # the brute force is quadratic
            assert got[r.doc_id] == plain_result(words)
    assert len(got) == len(rows) and changed > 5 and sum(x[0] > 0 for x in got.values()) > 5


def test_repeats_of_odd_rows(spark):
    rows = spark.createDataFrame([(None, "a  b"), (4, None), (4, " \n"), (4, "a  b")], "doc_id long, text string")
    out = [(r.doc_id, r.text) for r in runs.with_repeats(rows).collect()]
    assert out[0] == (None, "a  b") and out[1] == (4, None) and len(out) == 4
