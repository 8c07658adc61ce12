"""The corpus operators against brute force, round trips and edge cases."""

import gzip
import hashlib
import re
import tarfile
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from oracle import connect, same
from pyspark.sql import functions as F

from tallyloom.llm import bpe, chat, components, embeddings, media, mixing, quality, queries, secrets, shingles, simhash, urls, warc
from tallyloom.llm.files import Ranges

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def document(rng, n):
    return " ".join(rng.choice(WORDS, n))


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, empty, null, blank, one-word and long texts."""
    rng = np.random.default_rng(5)
    base = [document(rng, n) for n in (60, 200, 400, 30, 3000)]
    near = [t + " omega" for t in base] + [t.replace("alpha", "ALPHA", 1) for t in base]
    return [*base, *base[:2], *near, "", None, " \t\n", "word", "word", "Word", "a b", "\u00a0x y\u2003z", "é" * 50, base[0] + "\x00"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"src{i % 3}" if i % 5 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- near-duplicates by SimHash


def plain_fingerprint(text, words=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, radius=4):
    of = list(range(len(ids)))
    for _ in ids:
        for i in range(len(ids)):
            for j in range(len(ids)):
                if (fps[i] ^ fps[j]).bit_count() <= radius:
                    of[i] = of[j] = min(of[i], of[j])
    return {x: min(ids[j] for j in range(len(ids)) if of[j] == of[i]) for i, x in enumerate(ids)}


def test_simhash_against_brute_force(spark, docs, texts):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in enumerate(fps)}
    assert {i: r.component_id for i, r in got.items()} == plain_components(list(range(len(texts))), fps)


def test_simhash_edge_cases(spark, docs, empty):
    assert simhash.near_duplicates(empty).count() == 0
    odd = docs.limit(3).unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None, "x y", None, None, None)], DOCS)).withColumns({"fp": F.lit("clash"), "component_id": F.lit(1)})
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == 7 and sum(r.component_id is None for r in got) == 1
    assert simhash.keep_one(odd).count() == 4 and simhash.keep_one(odd).columns == odd.columns


def test_bk_trees_find_what_a_scan_finds():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 3).astype(np.uint64)
    fp = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 80).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 80).astype(np.uint64)) for c in centre]))
    tree = simhash.BKForest(fp, np.zeros(len(fp), np.int64))
    found = {(int(q), int(n)) for a, b in tree.search(fp, tree.root, 4) for q, n in zip(a, b)}
    assert found == {(i, j) for i in range(len(fp)) for j in range(len(fp)) if int(fp[i] ^ fp[j]).bit_count() <= 4}


def test_hot_shards_are_split_without_loss(spark):
    rng = np.random.default_rng(4)
    fp = sorted({int(np.int64(123456789) ^ sum(np.int64(1) << np.int64(b) for b in rng.choice(62, rng.integers(1, 7), False))) for _ in range(300)})
    links = spark.createDataFrame([(f,) for f in fp], "fp long")
    one, many = (dict(map(tuple, components.connected_components(simhash.fingerprint_links(links, tree=n)).collect())) for n in (4096, 32))
    want = plain_components(fp, fp)
    assert one == many == {f: c for f, c in want.items() if list(want.values()).count(c) > 1}


@pytest.mark.parametrize("shards", [1, 2**13, 2**22, 2**30])
def test_blocks_lose_no_link(shards):
    rng = np.random.default_rng(1)
    masks = [m & (2**64 - 1) for m in simhash.block_masks(4, shards)]
    for _ in range(300):
        flips = sum(1 << int(b) for b in rng.choice(64, 4, False))
        assert any(not flips & m for m in masks)


def test_components_of_a_chain_and_a_star(spark):
    e = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(200, 260)] + [(5, 5), (None, 3), (1, None)]
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(e, "a long, b long")).collect()))
    assert got == {**{i: 100 for i in range(100, 181)}, **{i: 7 for i in (7, *range(200, 260))}}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- near-duplicates of the pipeline, by shingles


def plain_similar(texts, words=5):
    """Least index of each text's component over links of similarity 0.8."""
    sets = []
    for t in texts:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode().split()
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    of = list(range(len(texts)))
    like = [[j for j, b in enumerate(sets) if a == b or a and b and 5 * len(a & b) >= 4 * len(a | b)] for a in sets]
    for _ in texts:
        for i, near in enumerate(like):
            of[i] = min([of[i], *(of[j] for j in near)])
    return of


@pytest.mark.parametrize("part", [1024, 8])
def test_near_copies_leave_the_pipeline(spark, texts, monkeypatch, part):
    import corpus_pipeline

    monkeypatch.setattr(shingles, "PART", part)
    rng = np.random.default_rng(8)
    base = [document(rng, 60) for _ in range(40)]
    edited = [" ".join(x if i != 30 else "omega" for i, x in enumerate(t.split())) for t in base]  # 51 of 61 shingles shared: 0.836
    hot = [" ".join([*base[0].split()[:58], f"end{i}"]) for i in range(60)]
    rows = [*base, *edited, *hot, *texts]
    docs = spark.createDataFrame([(i, t, "en", "src", 1) for i, t in enumerate(rows)] + [(None, base[0], "en", "src", 1)], DOCS)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()
    want = {i for i, c in enumerate(plain_similar(rows)) if i == c}
    assert {r.doc_id for r in got} == want | {None} and len(got) == len(want) + 1 and not want & set(range(40, 140))
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), FOLDER).count() == 0


# --- mixing


def test_mixing_against_sql(spark):
    same(queries.QUERIES["op2_poisson_mixing"](spark, FOLDER).toPandas(), connect(FOLDER).execute(queries.ORACLE["op2_poisson_mixing"]).df())


def test_mixing_rates_and_repeatability(spark):
    rows = spark.createDataFrame([(i, "t", "en", "big" if i < 6000 else None if i < 7000 else "small", 1) for i in range(8000)], DOCS)
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0), ("absent", 9.0)], "source string, weight double")
    out = mixing.mix(rows, weights=weights, total=4000.0)
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["big"] - 1000) < 160 and abs(n["small"] - 3000) < 270 and None not in n
    assert out.exceptAll(mixing.mix(rows, weights=weights, total=4000.0)).count() == 0
    u = mixing.replication_counts(rows, weights=weights, total=4000.0).where("d.source = 'small'").agg(F.avg("copies"), F.variance("copies")).first()
    assert abs(u[0] - 3) < 0.3 and abs(u[1] - 3) < 0.6  # a Poisson distribution's mean and variance agree


def test_many_sources_meet_by_salted_parts(spark, docs, monkeypatch):
    few = mixing.mix(docs, total=60.0)
    monkeypatch.setattr(mixing, "SOURCES", 1)
    many = mixing.mix(docs, total=60.0)
    assert "BroadcastHashJoin" in few._jdf.queryExecution().toString() and many.count() == few.count() > 0
    assert many.exceptAll(few).count() == few.exceptAll(many).count() == 0


def test_mixing_edge_cases(spark, docs, empty):
    assert mixing.mix(empty).count() == 0
    out = mixing.mix(docs.withColumns({"copy_no": F.lit("x"), "rate": F.lit(1), "n": F.lit(2), "d": F.lit(3)}))
    assert out.columns == [*docs.columns, "rate", "n", "d", "copy_no", "shuffle_key"] and dict(out.dtypes)["copy_no"] == "int"
    zero = spark.createDataFrame([("src0", 0.0), (None, -1.0)], "source string, weight double")
    assert mixing.mix(docs, weights=zero).count() == 0
    large = mixing.mix(docs.where("doc_id < 3"), total=9000.0)
    assert abs(large.count() - 9000) < 8 * 9000**0.5


def test_a_tiny_source_beside_a_large_one_is_drawn(spark):
    rows = spark.range(400_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") > 0, "large").alias("source"))
    n = {r.source: r["count"] for r in mixing.mix(rows).groupBy("source").count().collect()}
    assert abs(n[None] - 400_000 / (1 + 399_999**0.5)) < 8 * 632**0.5 and n["large"] > 390_000
    rows = spark.range(2_400_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "small").otherwise("large").alias("source"))
    weights = spark.createDataFrame([("small", 1.0)], "source string, weight double")
    u = mixing.replication_counts(rows, weights=weights).groupBy("d.source").agg(F.avg("copies").alias("mean"), F.variance("copies").alias("var"))
    u = {r.source: r for r in u.collect()}
    assert abs(u["small"].mean - 1200) < 5 and 0.85 < u["small"]["var"] / 1200 < 1.15 and u["large"].mean == 0


# --- URLs


def plain_verdicts(urls_):
    """The whole method in plain Python."""
    from collections import Counter
    from math import log

    def parts(u):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")

    def rule(h, p):
        fit = [(len(r), r, v) for v, r in urls.RULES for at, _, rest in [r.partition("/")] if (h == at or h.endswith("." + at)) and p.startswith("/" + rest)]
        return max(fit)[1:] if fit else (None, None)

    rows = [(*parts(u), *rule(*parts(u))) for u in urls_]
    before = urls.ORDER - 1
    grams = lambda t: [f"{urls.START * before}{t}{urls.END}"[i : i + urls.ORDER] for i in range(len(t) + 1)]
    sides = {u or "": {v} for u, (_, _, _, v) in zip(urls_, rows)}
    held = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:13], 16) % urls.FOLDS == 0
    counts = {v: [Counter(g[-k:] for t, s in sides.items() if v in s and not held(t) for g in grams(t)) for k in range(1, urls.ORDER + 1)] for v in ("allow", "block")}
    contexts = {v: [Counter() for _ in c] for v, c in counts.items()}
    kinds = {v: [Counter(y[:-1] for y in level) for level in c] for v, c in counts.items()}
    for v, c in counts.items():
        for k, level in enumerate(c):
            for y, n in level.items():
                contexts[v][k][y[:-1]] += n
    symbols = len({g[-1] for t in sides for g in grams(t)})

    def chance(v, g):
        p = 1 / symbols
        for k, c in enumerate(counts[v], 1):
            at = g[-k:-1]
            if n := contexts[v][k - 1][at]:
                t = kinds[v][k - 1][at]
                p = (c[g[-k:]] + t * p) / (n + t)
        return p

    known = all(sum(c[0].values()) for c in counts.values())
    score = {t: sum(round((log(chance("allow", g)) - log(chance("block", g))) * urls.UNIT) if known else 0 for g in grams(t)) / len(grams(t)) for t in sides}
    side = {v: [score[t] for t, s in sides.items() if v in s and held(t)] for v in ("allow", "block")}
    cut = 0.0
    if all(side.values()):
        (a, sa), (b, sb) = ((np.mean(side[v]), np.std(side[v]) + 1) for v in ("allow", "block"))
        cut = (a * sb + b * sa) / (sa + sb)
    return [(h, p, r, v or ("allow" if score[u or ""] >= cut else "block")) for u, (h, p, r, v) in zip(urls_, rows)]


def test_urls_against_plain_python(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url").limit(80)
    odd = ["http://A.com", "http://www.Example.com/en/x?y", "https://sub.example.com/en/", "http://example.com/EN/", "x://net/es/a", "http://anet/es/", "no scheme", "", None, "a://b://c.com/", "http://xcom/", "http://com/#f", "ftp://u.net/fr/\nz", "http://é.org/ü", "http://😀.org/漢字?q=😀", "http://a.org/x\x02"]
    rows = pages.unionByName(spark.createDataFrame([(None if i == 3 else 10_000 + i, u) for i, u in enumerate(odd + odd[:2])], "page_id long, url string"))
    got = urls.judge(rows.withColumns({"text": F.lit(1), "gram": F.lit(2), "score": F.lit(3)})).orderBy("host", "path", "rule").collect()
    assert len(got) == rows.count()
    want = plain_verdicts([r.url for r in rows.collect()])
    assert sorted(str((r.host, r.path, r.rule, r.verdict)) for r in got) == sorted(map(str, want))


def test_urls_without_rules_or_rows(spark):
    rows = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    assert [r.verdict for r in urls.judge(rows).collect()] == ["allow", "allow"]
    assert urls.judge(rows.limit(0)).count() == 0


def test_url_query(spark):
    same(queries.QUERIES["op3_url_filters"](spark, FOLDER).toPandas(), connect(FOLDER).execute(queries.ORACLE["op3_url_filters"]).df())


def test_very_long_urls(spark):
    """Linear in a URL's length, and the query string counts."""
    rows = [(i, f"http://a.{'com' if i % 2 else 'net/es'}/{i}") for i in range(40)]
    rows += [(100, "http://a.org/" + "x/é" * 40_000), (101, "http://a.org/?q=" + "y" * 100_000), (102, "http://a.org/?com"), (103, "http://a.org/?net/es/")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert len(got) == len(rows) and len(got[100].path) == 120_001 and got[101].path == "/"
    assert got[102].score != got[103].score


# --- media


def test_media_round_trip(spark, docs, texts, tmp_path):
    got = {r.doc_id: r for r in media.media_columns(docs.withColumns({"digest": F.lit(1), "shard": F.lit(2)}), f"file://{tmp_path}").collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.width, r.width * r.height, r.bits, r.media_sha256) == (64, len(payload), 8, r.digest)
    names = [m.name for p in tmp_path.glob("*.tar") for m in tarfile.open(p)]
    assert {r.digest + ".png" for r in got.values()} == set(names)


def test_media_rows_point_into_the_shards(spark, docs, tmp_path):
    rows = media.write_shards(docs, str(tmp_path))
    r = rows.where("doc_id = 0").first()
    image = Ranges().read(r.shard, r.offset, r.length)
    assert hashlib.sha256(image).hexdigest() == r.digest and media.header_of(image[: media.HEADER_BYTES])[0] == 64
    place = media.objects(rows)
    assert place.count() == place.select("digest").distinct().count() == rows.select("digest").distinct().count()
    with pytest.raises(ValueError):
        media.from_png(image[:60] + bytes([image[60] ^ 1]) + image[61:])


@settings(max_examples=50, deadline=None)
@given(st.text(max_size=300))
def test_png_is_lossless(text):
    payload, n = media.payload_of(text)
    assert media.from_png(media.to_png(payload)) == payload and payload[:n] == text.encode() and not payload[n:].strip(b"\0")


def test_media_of_nothing(empty, tmp_path):
    assert media.media_columns(empty, str(tmp_path)).count() == 0


# --- quality


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op5_quality_classifier"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_quality_looks_at_text_alone(spark, docs):
    labels = spark.createDataFrame([(i, int(i % 2), None) for i in range(20)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    a = {r.doc_id: r.score for r in quality.score(docs, labels).collect()}
    assert a[0] == a[5] and 0 <= min(a.values()) <= max(a.values()) <= 1 and len(a) == docs.count()
    odd = docs.withColumns({"score": F.lit("clash"), "log_bytes": F.lit(1), "lang": F.lit("zz"), "source": F.lit(None)})
    assert {r.doc_id: r.score for r in quality.score(odd, labels).collect()} == a


def test_quality_without_labels_or_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(empty, none).count() == 0 and quality.accept(docs, none).count() == docs.count()


def plain_score(model, x):
    """The additive model, evaluated one row and one table at a time."""
    out = []
    for row in x:
        z = model.base + sum(t[sum(e <= v for e in edges)] for v, edges, t in zip(row, model.edges, model.tables))
        for (i, j), t in model.pairs.items():
            z += t[sum(e <= row[i] for e in model.pair_edges[i])][sum(e <= row[j] for e in model.pair_edges[j])]
        out.append(1 / (1 + np.exp(-z)))
    return np.array(out)


def test_quality_scores_against_plain_tables(spark):
    """Every score is the sum of looked-up bins of the text's features."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(quality.featurise(docs, "doc_id"), labels)
    assert model.pairs
    rows = docs.select("doc_id", "text").collect()
    want = dict(zip((r.doc_id for r in rows), plain_score(model, [quality.features(r.text) for r in rows])))
    for r in queries.QUERIES["op5_quality_classifier"](spark, FOLDER).collect():
        assert abs(r.score - want[r.doc_id]) < 1e-9 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_quality_of_repeated_ids_and_long_texts(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    twice = docs.unionByName(docs.withColumn("text", F.concat("text", F.lit(" more")))).unionByName(spark.createDataFrame([(None, "word " * 300_000, None, None, None)], DOCS))
    a, b = (quality.train(quality.featurise(d.repartition(n)), labels) for d, n in ((twice, 1), (twice, 3)))
    assert all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables))
    assert quality.score(twice, labels).count() == twice.count()


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit(x[:3000], y[:3000])
    assert (0, 1) in m.pairs and ((m.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


# --- secrets


def plain_spans(text):
    t, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.IGNORECASE | re.ASCII):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "API_KEY", "apikey", "passwd", "=", ":", " ", "'", '"', "abc", "abcdef", "AKIA", "ABCDEFGH12345678", "0123456789abcdef0123", "beef", "é", "\n", "ſecret", "-"]), max_size=14).map("".join))
def test_secret_spans(text):
    assert [(s, k, e) for k, s, e, _ in secrets.find(text)] == plain_spans(text)


def secret_rows(spark):
    key = lambda c: "AKIA" + c * 16
    rows = [(i, f"é see {key('A')} here", "en", f"src{i}", 1) for i in range(6)] + [(10, f"x {key('B')} y token={'b' * 30} z", "en", "src1", 1), (11, None, "en", "src1", 1), (12, "", None, None, 1), (13, f"password: {'c' * 24}", "en", None, 1)]
    return spark.createDataFrame(rows, DOCS)


def test_copied_examples_and_live_secrets(spark):
    got = {r.doc_id: r for r in secrets.scan(secret_rows(spark)).collect()}
    assert all(len(got[i].found) == 1 and not got[i].live for i in range(6))
    assert [tuple(s) for s in got[10].live] == [(2, 22), (25, 61), (31, 61)] and not got[11].found and not got[12].live
    assert got[11].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[0].base_sha256 == hashlib.sha256(b"access:6:26").hexdigest()


def test_one_owner_with_many_repositories_is_not_copied(spark):
    key = "AKIA" + "D" * 16
    rows = [(i, f"see {key}", lang, "src1", 1) for i, lang in enumerate(("de", "en", "es", "fr"))]
    docs = spark.createDataFrame(rows, DOCS).unionByName(secret_rows(spark).where("doc_id < 6").withColumn("doc_id", F.col("doc_id") + 100))
    got = {r.doc_id: [tuple(s) for s in r.live] for r in secrets.scan(docs).collect()}
    assert all(got[i] == [(4, 24)] for i in range(4)) and all(not got[100 + i] for i in range(6))
    assert all(("AKIA" in r.text) == (r.doc_id >= 100) for r in secrets.redact(docs).collect())


def test_redaction(spark, empty):
    docs = secret_rows(spark).withColumns({"live": F.lit("clash"), "_row": F.lit(1)})
    out = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert out[10] == "x <secret> y <secret> z" and out[13] == "<secret>" and out[11] is None and "AKIA" in out[0] and len(out) == 10
    assert secrets.redact(docs).columns == docs.columns
    assert secrets.redact(empty).count() == secrets.scan(empty).count() == 0
    twice = docs.where("doc_id = 10").unionByName(docs.where("doc_id = 10"))
    assert [r.text for r in secrets.redact(twice).collect()] == ["x <secret> y <secret> z"] * 2


def test_secret_query(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op6_secret_scans"](spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        want = plain_spans(r.text)
        base = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in want)
        g = got[r.doc_id]
        assert g.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and (g.n_assign, g.n_access, g.n_hex) == tuple(sum(k == i for _, k, _ in want) for i in range(3))
        assert ",".join(x for x in g.spans.split(",") if not x.startswith("live")) == base


def plain_live(docs):
    """(start, end) of the live spans of each text: values of at most OWNERS sources, or of at most REPOSITORIES pairs of source and language."""
    group = {0: 2, 1: 0, 2: 0}
    forms = [(secrets.ASSIGN, 0), (secrets.ACCESS, 1), (secrets.HEX, 2)]
    found = [[(m.start(), m.end(), m[group[k]]) for form, k in forms for m in re.finditer(form, r.text or "") if len(m[group[k]]) >= secrets.LEAST[secrets.KINDS[k]]] for r in docs]
    owners, repositories = {}, {}
    for r, spans in zip(docs, found):
        for *_, v in spans:
            owners.setdefault(v, set()).add(r.source or "")
            repositories.setdefault(v, set()).add((r.source or "", r.source, r.lang))
    live = lambda v: len(owners[v]) <= secrets.OWNERS or len(repositories[v]) <= secrets.REPOSITORIES
    return [sorted((s, e) for s, e, v in spans if live(v)) for spans in found]


def test_live_spans_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: [x.split(":")[1:] for x in r.spans.split(",") if x.startswith("live")] for r in queries.QUERIES["op6_secret_scans"](spark, "/root/testdata/sf0.01").collect()}
    want = plain_live(docs)
    assert any(want)
    for r, spans in zip(docs, want):
        assert [tuple(map(int, x)) for x in got[r.doc_id]] == spans


def test_a_text_full_of_secrets(spark):
    one = "token=" + "a1" * 12 + " "
    docs = spark.createDataFrame([(1, one * 5000 + "é", "en", "s", 1)], DOCS)
    assert secrets.redact(docs).first().text == "<secret> " * 5000 + "é"


# --- archives


def page_rows(spark):
    big, other = "x" * 150, "y" * 120
    rows = [(5, "http://a/1", big), (3, "http://a/2 b\r\nc", big), (9, None, big), (4, "u", "small"), (2, "u", "small"), (7, "v", None), (8, "v", ""), (6, "é", other + "é"), (3, "http://a/2", other), (1, "w", other), (None, "n", other)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_revisits(spark, tmp_path):
    archives = warc.write_archives(page_rows(spark).withColumns({"digest": F.lit(1), "refers_to": F.lit(2), "id": F.lit(3)}), str(tmp_path))
    rows = [tuple(r) for r in warc.read_archives(archives).select("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest").collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    big, other = "x" * 150, "y" * 120
    want = [(5, "revisit", 3, 150, sha(big)), (3, "response", None, 150, sha(big)), (9, "revisit", 3, 150, sha(big)), (4, "response", None, 5, sha("small")), (2, "response", None, 5, sha("small")), (7, "response", None, 0, sha("")), (8, "response", None, 0, sha("")), (6, "response", None, 122, sha(other + "é")), (3, "revisit", 1, 120, sha(other)), (1, "response", None, 120, sha(other)), (None, "revisit", 1, 120, sha(other))]
    assert sorted(map(str, rows)) == sorted(map(str, want))


def test_archives_are_gzip_members_with_fresh_headers(spark, tmp_path):
    archives = warc.write_archives(page_rows(spark), str(tmp_path), date="2026-01-02T03:04:05Z")
    data = b"".join(gzip.decompress(open(r.path, "rb").read()) for r in archives.collect())
    assert data.count(b"WARC/1.1\r\n") == 11 and data.count(b"WARC-Type: revisit") == 4 and data.count(b"WARC-Date: 2026-01-02T03:04:05Z") == 11
    assert data.count(b"x" * 150) == 1 and b"WARC-Target-URI: http://a/2%20b%0D%0Ac\r\n" in data
    path = archives.first().path
    open(f"{tmp_path}/cut.gz", "wb").write(open(path, "rb").read()[:-20])
    with pytest.raises(ValueError):
        list(warc.members(f"{tmp_path}/cut.gz"))


def test_revisits_of_nothing(spark, tmp_path):
    assert warc.read_archives(warc.write_archives(page_rows(spark).limit(0), str(tmp_path))).count() == 0


def test_revisit_query(spark):
    same(queries.QUERIES["op7_warc_revisits"](spark, FOLDER).toPandas(), connect(FOLDER).execute(queries.ORACLE["op7_warc_revisits"]).df())


# --- embeddings


def vectors(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((4, 16))
    rows = [(c + 0.12 * rng.standard_normal(16)).tolist() for c in np.repeat(centre, 40, axis=0)] + [centre[0].tolist()] * 30
    rows = [(i, v, int(i % 2)) for i, v in enumerate(rows)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] + [0.0] * 15, centre[0].tolist()[:8], (centre[0] * 1e300).tolist(), (-centre[0]).tolist()]
    rows += [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(2000, centre[0].tolist(), None), (3, centre[0].tolist(), 0), (None, centre[1].tolist(), 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def plain_links(rows, threshold=0.93):
    def unit(r):
        v = r.embedding
        if r.label is None or not v or None in v or not np.isfinite(v).all() or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.linalg.norm(v)

    u = [unit(r) for r in rows]
    links = [[j for j in range(len(rows)) if j != i and u[i] is not None and u[j] is not None and rows[i].label == rows[j].label and len(u[i]) == len(u[j]) and u[i] @ u[j] >= threshold] for i in range(len(rows))]
    of, out = list(range(len(rows))), []
    for _ in rows:
        for i, near in enumerate(links):
            of[i] = min([of[i], *(of[j] for j in near)])
    for i, r in enumerate(rows):
        ids = [rows[j].vec_id for j in range(len(rows)) if of[j] == of[i] and rows[j].vec_id is not None]
        c = min(ids) if ids else None
        out.append((r.vec_id, len(links[i]), c, r.vec_id is not None and r.vec_id == c))
    return out


@pytest.mark.parametrize("block", [1024, 16])
def test_embeddings_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = vectors(spark)
    got = embeddings.near_duplicates(rows.withColumns({"row": F.lit(1), "key": F.lit(2), "n_links": F.lit(3)}), window=16)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_links(rows.collect())))


def test_embedding_query(spark):
    same(queries.QUERIES["op8_embedding_near_dedup"](spark, FOLDER).toPandas(), connect(FOLDER).execute(queries.ORACLE["op8_embedding_near_dedup"]).df())


def test_embeddings_of_nothing(spark):
    assert embeddings.near_duplicates(vectors(spark).limit(0)).count() == 0
    assert embeddings.projection_links(spark.createDataFrame([], "node long, label int, vec binary"), "<f8").count() == 0


def test_hashes_agree_more_the_nearer_two_vectors_are():
    cosines, chance = embeddings.agreement()
    assert (np.diff(chance) >= 0).all() and chance[-1] == 1 and np.interp(0.93, cosines, chance) > 0.5 > np.interp(0.5, cosines, chance)


def dense_label(rng, n=6400, planted=400, width=64):
    """Vectors of one label at pairwise cosines of about 0.8, the last `planted` of them each at 0.935 with one of the first."""
    mean = rng.standard_normal(width)
    mean /= np.linalg.norm(mean)

    def at(c, of, away):
        away = away - (away @ of)[:, None] * of if of.ndim == 1 else away - (away * of).sum(1)[:, None] * of
        return c * of + np.sqrt(1 - c * c) * away / np.linalg.norm(away, axis=1)[:, None]

    base = at(np.sqrt(0.8), mean, rng.standard_normal((n - planted, width)))
    return np.concatenate([base, at(0.935, base[:planted], rng.standard_normal((planted, width)))])


@pytest.mark.parametrize(("partitions", "rest"), [(8, 4096), (200, 0)])
def test_embeddings_of_a_dense_label(spark, partitions, rest):
    """Recall at a dense hot label; without blocks (rest 0) the passes alone must come near it."""
    x = dense_label(np.random.default_rng(1))
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    rows = embeddings.stored(rows, "dense")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = np.array([r.n_links for r in embeddings.near_duplicates(rows, rest=rest).orderBy("vec_id").collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    like = x @ x.T >= embeddings.THRESHOLD
    want = like.sum(axis=1) - 1
    assert want.sum() >= 800 and (got <= want).all()
    assert got.sum() >= 0.99 * want.sum()


# --- chats


def chat_rows(spark):
    rows = [(1, 0, "system", "be <|end|> brief"), (1, 1, "user", "hi " * 60), (1, 2, "assistant", "yo " * 90), (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "assistant", "\\<|turn|>\\<\\|" * 40)]
    rows += [(1, 6 + i, ("user", "assistant")[i % 2], f"t{i} " * (i % 7) * 8) for i in range(40)] + [(1, 50, "assistant", "long " * 900), (1, 51, "user", "end")]
    rows += [(2, 0, "system", "only"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (3, None, None, "first<"), (None, 1, "us<|text|>er", "|x"), (4, 1, "system", "late"), (4, 0, "user", "<|")]
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")


def test_chats_round_trip(spark):
    turns = chat_rows(spark)
    out = chat.windows(turns.withColumns({"pos": F.lit(1), "rows": F.lit(2), "window": F.lit(3)}), budget=200, history=60)
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    plain = {}
    for r in sorted(turns.collect(), key=lambda r: (r.turn is not None, r.turn or 0, r.role or "", r.text or "")):
        plain.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    assert set(got) == set(plain)
    for c, rows in plain.items():
        g, loss = got[c], "".join(t for role, t in rows if role == "assistant")
        assert (g.n_turns, g.loss_chars) == (len(rows), len(loss))
        assert g.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in rows).encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_windows_are_filled(spark):
    """Short turns fill what the budget leaves; given tokens are counted instead of characters."""
    turns = spark.range(3000).select(F.lit(1).alias("conv_id"), F.col("id").cast("int").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.lit("abcdefgh" * 5).alias("text"), F.lit(50).alias("n_tokens"))
    plain, counted = (chat.windows(turns, tokens_col=c).selectExpr("max(length(text)) AS top", "avg(length(text)) AS mean", "count(*) AS n").first() for c in (None, "n_tokens"))
    assert plain.top <= 4 * chat.BUDGET and plain.mean > 0.85 * 4 * chat.BUDGET
    assert counted.n > 1.5 * plain.n


def test_chat_windows_keep_budget_and_system_turn(spark):
    rows = chat.windows(chat_rows(spark), budget=200, history=60).where("conv_id = 1").orderBy("window").collect()
    assert len(rows) > 3 and [r.window for r in rows] == list(range(len(rows)))
    cost = lambda p: -(-(len(p) + len(chat.END)) // chat.CHARS)
    for r in rows:
        parts = r.text.split(chat.END)[:-1]
        assert parts[0].startswith(f"{chat.TURN}system{chat.TEXT}be ") and (r.repeated >= 1 or r.window == 0)
        assert sum(map(cost, parts)) <= 200 or len(parts) - r.repeated == 1
        assert sum(map(cost, parts[1 : r.repeated])) <= 60
        ends = [0]
        for p in parts:
            ends.append(ends[-1] + len(p) + len(chat.END))
        assert all(s.start >= ends[r.repeated] for s in r.loss)
    assert any(r.repeated > 1 for r in rows)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet="\\<|a", max_size=12))
def test_escape_is_reversible(spark, text):
    r = spark.range(1).select(chat.escape(F.lit(text)).alias("e"), chat.unescape(chat.escape(F.lit(text))).alias("u")).first()
    assert r.u == text and not any(x in r.e for x in (chat.TURN, chat.TEXT, chat.END)) and "<|" not in r.e


def test_chat_query(spark):
    got = {r.conv_id: r for r in queries.QUERIES["op9_chat_formatting"](spark, FOLDER).collect()}
    said = "</s>[INST] ok [/INST]"
    assert got[-7].n_turns == 2 and got[-7].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[-7].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert len(got) == 1 + spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id").distinct().count()
    assert chat.windows(chat_rows(spark).limit(0)).count() == 0


# --- byte-level BPE


@pytest.fixture(scope="module")
def reference_encoding():
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(bpe.VOCABULARY), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abc  \n\t'sé漢😀0123", max_size=60))
def test_bpe_as_the_library_encodes(reference_encoding, text):
    text = text.encode("utf-8", "ignore").decode()
    t = bpe.tokenizer(*bpe.default_vocabulary())
    ids = t.encode(text)
    assert ids.tolist() == reference_encoding.encode_ordinary(text) and t.decode(ids) == text.encode()


def test_prefix_table_appends_and_edits():
    v, rng = bpe.tokenizer(*bpe.default_vocabulary()).v, np.random.default_rng(0)
    for _ in range(60):
        piece = bytes(rng.choice(list(b"thereationing "), rng.integers(1, 30)).tolist())
        e = bpe.PrefixEncoder(v, piece[:5]).append(piece[5:])
        assert e.last == bpe.PrefixEncoder(v, piece).last and e.ids() == v._merge(piece)
        assert all(e.ids(k) == v._merge(piece[:k]) for k in range(len(piece) + 1))
        a, b = sorted(rng.integers(0, len(piece) + 1, 2).tolist())
        assert e.edit(a, b, b"on").ids() == v._merge(piece[:a] + b"on" + piece[b:])


def test_bpe_round_trip(spark, docs, texts, empty, reference_encoding):
    got = {r.doc_id: r for r in bpe.round_trip(docs.withColumn("n_tokens", F.lit("clash"))).collect()}
    for i, t in enumerate(texts):
        ids = reference_encoding.encode_ordinary(t or "")
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode(empty).count() == 0
    assert [len(r.token_ids) for r in bpe.encode(docs).orderBy("doc_id").collect()] == [got[i].n_tokens for i in range(len(texts))]


def test_forgetting_pieces_changes_nothing(monkeypatch, reference_encoding):
    monkeypatch.setattr(bpe, "PIECES", 3)
    monkeypatch.setattr(bpe, "PAIRS", 3)
    t = bpe.Tokenizer(*bpe.default_vocabulary())
    text = " ".join(f"word{i} thereation" for i in range(200))
    assert t.encode(text).tolist() == reference_encoding.encode_ordinary(text)


# --- very long texts


@pytest.fixture(scope="module")
def long_docs(spark):
    """A text of some megabytes, with a secret near its end, twice, and a short one."""
    text = ("alpha beta gamma é " * 150_000) + "token=" + "a1" * 12
    return spark.createDataFrame([(1, text, "en", "s", len(text)), (2, text, "en", "s", len(text)), (3, "alpha", "en", "s", 5)], DOCS)


def test_a_very_long_text_in_each_operator(spark, long_docs, tmp_path):
    text = long_docs.first().text
    raw = text.encode()
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(long_docs).collect()} == {1: 1, 2: 1, 3: 3}
    got = {r.doc_id: r for r in media.media_columns(long_docs, f"file://{tmp_path}").collect()}
    assert got[1].n_bytes == len(raw) and got[1].payload_sha256 == got[2].payload_sha256 == hashlib.sha256(raw + b"\0" * (-len(raw) % 64)).hexdigest()
    tokens = {r.doc_id: r for r in bpe.round_trip(long_docs.select("doc_id", "text")).collect()}
    assert tokens[1].decoded_sha256 == hashlib.sha256(raw).hexdigest() and tokens[1].n_tokens > 100_000
    spans = {r.doc_id: r.found for r in secrets.scan(long_docs).collect()}
    assert [(s.start, s.end) for s in spans[1]] == [(len(text) - 30, len(text)), (len(text) - 24, len(text))]
    assert secrets.redact(long_docs).where("doc_id = 1").first().text.endswith("é <secret>")
    assert quality.featurise(long_docs).count() == 3


def test_a_very_long_page_and_a_long_conversation(spark, tmp_path):
    html = "<p>é</p>" * 400_000
    pages = spark.createDataFrame([(1, "http://a/", html), (2, "http://b/", html), (None, None, None)], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.read_archives(warc.write_archives(pages, str(tmp_path))).collect()}
    assert got[2].refers_to == 1 and got[2].payload_bytes == len(html.encode()) and got[None].payload_bytes == 0
    turns = spark.range(6000).select(F.lit(1).alias("conv_id"), F.col("id").cast("int").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.when(F.col("id") == 7, F.lit("long " * 200_000)).otherwise(F.lit("short")).alias("text"))
    back = chat.read_back(chat.windows(turns)).first()
    assert back.n_turns == 6000 and back.loss_chars == 2999 * 5 + 1_000_000
