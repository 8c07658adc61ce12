"""Tokens of two tokenizers aligned by the bytes they cover, each distinct segment once.

Texts are cut before runs of white space that follow something else and begin with a character before which no entry of either vocabulary
has any: which ones those are is looked up when they are loaded. So a text's tokens are those of its segments. Frequent segments are aligned and broadcast; each rare one
is aligned where all texts that hold it send their keys, and travels back to them. Texts are composed from both.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from array import array
from collections import Counter
from functools import lru_cache, partial
from itertools import repeat
from struct import pack, unpack

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import segments
from tallyloom.llm.common import stored, table

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Texts whose rare segments a task remembers to have sent; tasks among which a long segment's rows are spread; counts that a task gathers.
SENT, SPREAD, GATHERED = 100_000, 1000, 400_000
NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones as they are, others in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class Aligner:
    """Both tokenizers, and the links of two ids as one number: the first shifted by 32 bits, and the second."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters, of = byte_letters(), self.b.id_to_piece
        a = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        b = [bytes([int(of(i)[3:5], 16)]) if self.b.is_byte(i) else of(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.a_bytes, self.b_bytes, self.text = a, b, [str(i) for i in range(max(*a, len(b)) + 1)]
        whole = "\0".join(x.decode("utf-8", "replace") for x in (*a.values(), *b))
        cuts = [c for c in " \t\n\v\f\r" if not re.search(f"[^\\s\0]{c}", whole)]
        if " " not in cuts or any(b"\n" in x and not self.b.is_byte(i) for i, x in enumerate(b)):
            raise ValueError("a vocabulary has entries that go on after a word's or a line's end; texts can't be cut there")
        self.before = len(self.b.encode("\n"))
        cut = "".join(map(re.escape, cuts))
        self.split = re.compile(rf"[{cut}]\s*\S*(?:[^\S{cut}]\s*\S*)*").findall

    def words(self, text: str) -> list[str]:
        """The segments of a space and the text: each starts with white space, and joined they are both."""
        return self.split(f" {text}")

    def tally(self, texts):
        """Arrays of segments and their numbers, as soon as GATHERED are there and in the end; without those that came once till then, for
        this only serves to choose which are broadcast."""
        seen: Counter = Counter()

        def out():
            more = {s: n for s, n in seen.items() if n > 1}
            seen.clear()
            return pa.array(more.keys(), pa.string()), pa.array(more.values(), pa.int64())

        for text in texts:
            seen.update(self.words(text))
            if len(seen) > GATHERED:
                yield out()
        yield out()

    def align(self, found: list[str]) -> list[bytes]:
        """For each segment its groups in bytes: numbers of two bytes, or four where some are large, namely how many ids of each tokenizer a
        group has, and the ids. Nothing where the tokens' bytes are not the segment's."""
        a = [x.ids for x in self.a.encode_batch_fast(found, add_special_tokens=False)]
        b = [x[self.before :] for x in self.b.encode([f"\n{s}" for s in found], num_threads=1)]
        return [self._one(s.encode(), x, y) for s, x, y in zip(found, a, b)]

    def _one(self, raw: bytes, a: list[int], b: list[int]) -> bytes:
        size_a, size_b = [self.a_bytes[x] for x in a], [self.b_bytes[x] for x in b]
        if b"".join(size_a) != raw or b"".join(size_b) != raw:
            return b""
        out, i, j, n = [], 0, 0, len(a)
        while i < n:
            from_i, from_j, gap = i, j, len(size_a[i]) - len(size_b[j])
            while gap:
                if gap < 0:
                    i += 1
                    gap += len(size_a[i])
                else:
                    j += 1
                    gap -= len(size_b[j])
            i, j = i + 1, j + 1
            out += (i - from_i, j - from_j, *a[from_i:i], *b[from_j:j])
        return b"H" + array("H", out).tobytes() if max(out) < 1 << 16 else b"I" + array("I", out).tobytes()

    def read(self, entry: bytes) -> tuple[str, int, list[int]]:
        """The groups as text, the numbers of tokens, groups and links packed into one, and the links, repeats included."""
        x, text = memoryview(entry)[1:].cast(chr(entry[0])).tolist(), self.text
        at, end, groups, links, n_a, n_b = 0, len(x), [], [], 0, 0
        while at < end:
            n, m = x[at], x[at + 1]
            middle = at + 2 + n
            a, b = x[at + 2 : middle], x[middle : middle + m]
            at, n_a, n_b = middle + m, n_a + n, n_b + m
            if n == 1:  # linked with all of the other side
                groups.append(f"{text[a[0]]}|{','.join([text[y] for y in b])}")
                links += [a[0] << 32 | y for y in b]
                continue
            groups.append(f"{','.join([text[y] for y in a])}|{','.join([text[y] for y in b])}")
            if m == 1:
                links += [y << 32 | b[0] for y in a]
                continue
            size_a, size_b = self.a_bytes, self.b_bytes
            i, j, gap = 0, 0, len(size_a[a[0]]) - len(size_b[b[0]])
            links.append(a[0] << 32 | b[0])
            while i + 1 < n or j + 1 < m:
                if gap < 0:
                    i += 1
                    gap += len(size_a[a[i]])
                else:
                    j += 1
                    gap -= len(size_b[b[j]])
                links.append(a[i] << 32 | b[j])
        return ";".join(groups), packed(n_a, n_b, len(groups), len(links)), links


@lru_cache(maxsize=2)
def aligner(byte_level: str, pieces: str) -> Aligner:
    """One to a Python worker, kept from task to task."""
    return Aligner(byte_level, pieces)


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES)


class Frequent:
    """What is known of the frequent segments, broadcast as one Arrow table and laid out once a worker."""

    def __init__(self, spark, rows: DataFrame, load):
        self.load, out = load, pa.BufferOutputStream()
        t = rows.toArrow()
        with pa.ipc.new_stream(out, t.schema) as w:
            w.write_table(t)
        self.sent, self.name = spark.sparkContext.broadcast(out.getvalue().to_pybytes()), uuid.uuid4().hex

    def __hash__(self) -> int:
        return hash(self.name)

    def __eq__(self, other) -> bool:  # the same one in each task of a worker
        return self.name == other.name

    def columns(self) -> list[list]:
        return [c.to_pylist() for c in pa.ipc.open_stream(self.sent.value).read_all().columns]


@lru_cache(maxsize=1)
def _known(frequent: Frequent) -> dict[str, tuple]:
    """By segment its groups, its packed numbers and its links, where the tokens' bytes are its own."""
    same: dict = {}
    out = {}
    for piece, entry in zip(*frequent.columns()):
        if entry:
            groups, n, links = frequent.load().read(entry)
            out[piece] = groups, same.setdefault(n, n), tuple(same.setdefault(x, x) for x in links)
    return out


@lru_cache(maxsize=1)
def _worth(frequent: Frequent) -> dict[str, int]:
    """By segment how many of its links are best, and from the 41st bit on their counts' sum: one look-up for both."""
    return {p: n | c << 40 for p, n, c in zip(*frequent.columns())}


def packed(a: int, b: int, groups: int, links: int) -> int:
    """Four numbers that can be added as one, 40 bits each."""
    return a | b << 40 | groups << 80 | links << 120


def unpacked(x: int) -> list[int]:
    return [x >> s & (1 << 40) - 1 for s in (0, 40, 80, 120)]


def aligned(found: DataFrame, load) -> DataFrame:
    """found(piece) with entry, as align gives it, and links."""

    def run(batches):
        for b in batches:
            entries = load().align(b.column(0).to_pylist())
            links = [load().read(e)[2] if e else [] for e in entries]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(entries, pa.binary()), pa.array(links, pa.list_(pa.int64()))], ["piece", "entry", "links"])

    return found.select("piece").mapInArrow(run, "piece string, entry binary, links array<long>")


def _others(words: list[str], known: dict) -> list[str]:
    """The segments of a text that are not known, each once, in the order in which they come first."""
    return [w for w in dict.fromkeys(words) if w not in known]


def _rare(texts: DataFrame, load, frequent: Frequent) -> DataFrame:
    """(_key, at, piece) of the segments of each text that are not frequent, with their places among _others; a text is sent once a task."""

    def run(batches):
        known, sent = _known(frequent), set()
        for b in batches:
            for start in range(0, b.num_rows, 256):
                keys, places, pieces = [], [], []
                for key, text in zip(b.column(0).slice(start, 256).to_pylist(), b.column(1).slice(start, 256)):
                    if key not in sent:
                        sent = sent if len(sent) < SENT else set()
                        sent.add(key)
                        new = _others(load().words(text.as_py()), known)
                        keys += [key] * len(new)
                        places += range(len(new))
                        pieces += new
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(places, pa.int32()), pa.array(pieces, pa.string())], ["_key", "at", "piece"])

    return texts.select("_key", "text").mapInArrow(run, "_key binary, at int, piece string")


def _rare_aligned(rare: DataFrame, load) -> DataFrame:
    """(_key, own) of rare(_key, at, piece), repeated rows once: the place in four bytes, and the segment's entry.

    Rows of a segment meet and it is aligned once; those of a long one, which can be frequent all the same, meet in up to SPREAD places.
    """
    salt = F.when(F.length("piece") > segments.SHORT, F.pmod(F.xxhash64("_key"), F.lit(SPREAD))).otherwise(0)

    def run(batches):
        last, entry, before = None, None, None
        for b in batches:
            for part in (b.slice(i, 4000) for i in range(0, b.num_rows, 4000)):
                keys, places, pieces = (c.to_pylist() for c in part.columns)
                new = [p for p in dict.fromkeys(pieces) if p != last]
                entries = dict(zip(new, load().align(new)))
                entries.setdefault(last, entry)
                rows = [(k, pack("<I", at) + entries[p]) for old, k, at, p in zip([before, *zip(keys, pieces)], keys, places, pieces) if (k, p) != old]
                last, entry, before = pieces[-1], entries[pieces[-1]], (keys[-1], pieces[-1])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in (zip(*rows) if rows else ([], []))], ["_key", "own"])

    dealt = rare.repartition("piece", salt).sortWithinPartitions("piece", "_key")
    return dealt.mapInArrow(run, "_key binary, own binary")


def _composed(texts: DataFrame, load, frequent: Frequent) -> DataFrame:
    """Two kinds of rows of texts(_key, text, copies, own), where own holds the rare segments.

    With a key, of a text: its numbers, the digest of its groups, null where its tokens' bytes differ from it, and its rare segments' links
    with their frequencies. Without, of the task so far: a link, and how many documents have it.
    """
    fields = f"_key binary, {', '.join(f'{n} long' for n in NUMBERS)}, groups_sha256 string, pieces array<long>, times array<long>, link long, n long"
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = [pa.binary(), *[pa.int64()] * 4, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def of_text(words: list[str], own: list[bytes], known: dict) -> tuple[list, set]:
        entries, rare, new = list(map(known.get, words)), Counter(), {}
        if own:
            others = _others(words, known)
            for x in own:
                if len(x) == 4:  # its tokens' bytes are not its own
                    return [0, 0, 0, 0, None, [], []], set()
                new[others[unpack("<I", x[:4])[0]]] = load().read(x[4:])
            for at in [i for i, e in enumerate(entries) if e is None]:
                entries[at] = e = new[words[at]]
                rare.update(e[2])
        groups, numbers, links = zip(*entries)
        found = set().union(*links)
        return [*unpacked(sum(numbers)), hashlib.sha256(";".join(groups).encode()).hexdigest(), list(rare), list(rare.values())], found

    def run(batches):
        known, documents = _known(frequent), Counter()
        for b in batches:
            for start in range(0, b.num_rows, 64):
                rows = []
                for key, text, copies, own in zip(*(c.slice(start, 64).to_pylist() for c in b.columns)):
                    out, found = of_text(load().words(text), own or [], known)
                    rows.append((key, *out, None, None))
                    if copies == 1:
                        documents.update(found)
                    else:
                        documents.update(dict.fromkeys(found, copies))
                yield batch(rows)
                if len(documents) > 2 * GATHERED:
                    yield batch([(None,) * 8 + x for x in documents.items()])
                    documents.clear()
        if documents:
            yield batch([(None,) * 8 + x for x in documents.items()])

    return texts.select("_key", "text", "copies", "own").mapInArrow(run, fields)


def _frequent_sums(texts: DataFrame, load, frequent: Frequent) -> DataFrame:
    """(_key, n_best, count_sum) of each row of texts(_key, text), of its frequent segments."""

    def run(batches):
        worth = _worth(frequent)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                words = [load().words(t.as_py()) for t in b.column(1).slice(at, 256)]
                both = [sum(map(worth.get, w, repeat(0))) for w in words]
                sums = [pa.array([x & (1 << 40) - 1 for x in both], pa.int64()), pa.array([x >> 40 for x in both], pa.int64())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, 256), *sums], ["_key", "n_best", "count_sum"])

    return texts.select("_key", "text").mapInArrow(run, "_key binary, n_best long, count_sum long")


def align_tokens(docs: DataFrame, text_col: str = "text", byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """docs with text_col replaced by n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    The first tokenizer reads a space and the text, the second the text, to which it adds one; groups end where tokens of both end, and a
    link is a pair of tokens that share a byte. A pair of ids counts the documents that link it anywhere; n_best are the links whose count
    is the highest of their first id, count_sum is over all links. A text that is null or empty, or that either tokenizer changes (one with
    the mark U+2581), has zeros and an empty groups_sha256, and its tokens count nowhere.

    Every row is a document with its own result, so ids may repeat or be null and equal texts count each; texts are read whole. Columns
    of docs with the new names, or called _key, are replaced. An empty table gives an empty result. The OFTEN most frequent short
    segments are collected and broadcast with their alignments; others, and all texts once, are shuffled.
    """
    given = default_vocabularies() if byte_level is None or pieces is None else (None, None)
    load = partial(aligner, byte_level or given[0], pieces or given[1])
    spark, new = docs.sparkSession, [*NUMBERS, "n_best", "count_sum", "groups_sha256"]
    names = [c for c in docs.columns if c not in (text_col, "_key", *new)]
    key = F.when(F.length(text_col) > 0, F.substring(F.unhex(F.md5(F.col(text_col).cast("binary"))), 1, 12))
    texts = docs.select(key.alias("_key"), F.col(text_col).alias("text")).where("_key IS NOT NULL")
    hot = stored(aligned(segments.often(stored(segments.counted(texts, load), "counts")), load), "frequent")
    frequent = Frequent(spark, hot.select("piece", "entry"), load)
    own = _rare_aligned(_rare(texts, load, frequent), load).groupBy("_key").agg(F.collect_list("own").alias("own"))
    once = texts.groupBy("_key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    composed = stored(_composed(once.join(own, "_key", "left"), load, frequent), "composed")

    links = composed.where("link IS NOT NULL").groupBy(F.col("link").alias("piece")).agg(F.sum("n").alias("n"))
    links = stored(links, "links")
    first = F.shiftright("piece", 32).alias("a")
    top = links.groupBy(first).agg(F.max("n").alias("top"))  # as many rows as the first vocabulary has
    links = links.join(F.broadcast(top), F.shiftright("piece", 32) == F.col("a")).select("piece", "n", F.col("n").alias("count_sum"), (F.col("n") == F.col("top")).cast("long").alias("n_best"))
    values = ["n_best", "count_sum"]
    common = hot.select(F.col("piece").alias("segment"), F.explode("links").alias("piece")).join(links, "piece")
    common = common.groupBy(F.col("segment").alias("piece")).agg(*(F.sum(v).alias(v) for v in values))
    rare = segments.weighed(composed.where("_key IS NOT NULL").select("_key", "pieces", "times"), segments.often(links), links, values, "by-link")
    worth = _frequent_sums(texts, load, Frequent(spark, common.select("piece", *values), load))
    worth = worth.groupBy("_key").agg(F.count("*").alias("copies"), *(F.max(v).alias(v) for v in values))  # equal texts, equal sums
    worth = stored(worth, "worth")
    both = worth.select("_key", *values).unionByName(rare.select("_key", *values)).groupBy("_key").agg(*(F.sum(v).alias(v) for v in values))
    copies = worth.select("_key", "copies")
    good = F.col("groups_sha256").isNotNull()
    total = composed.where("_key IS NOT NULL").select("_key", *NUMBERS, "groups_sha256").join(both, "_key", "left").join(copies, "_key", "left")
    total = total.select("_key", "copies", *NUMBERS, *(F.when(good, F.col(v)).otherwise(0).alias(v) for v in values), "groups_sha256")
    out = segments.met(docs.select(*names, key.alias("_key")), total)
    return out.select(*names, *(F.coalesce(F.col(c), F.lit("" if c == "groups_sha256" else 0)).alias(c) for c in new))


def op12_token_alignment(spark, sf_dir):
    return align_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op12_token_alignment": op12_token_alignment}
ORACLE: dict[str, str] = {}
