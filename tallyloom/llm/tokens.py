"""Token counts without token ids: each distinct pre-token is tokenised once, and documents add up the counts of theirs.

A text is cut between two characters that stand side by side in no piece of the vocabulary: no merge can join what such a cut parts, so
the tokens of a text are those of its pre-tokens. Spaces before a word stay with it, since the vocabulary has pieces of both.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import segments
from tallyloom.llm.common import stored, table

VOCABULARY, LIMIT = "piece_bpe_32k.model", 4096
#: Characters that are cut at once.
BLOCK = 4_000_000


class PieceModel:
    """A sentencepiece model, and where texts can be cut for it. A mark in a text that stands for a space counts as one, as in the library."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(self.sp.get_piece_size()) if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i))]
        pieces = [self.sp.id_to_piece(i).replace("▁", " ") for i in plain]
        pairs = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        if any(p[1] == " " != p[0] or "\n" in p for p in pairs):
            raise ValueError("this vocabulary has pieces that go on after a word's or a line's end; texts can't be cut there")
        if [self.sp.encode(x) for x in ("a  b▁ c", " a")] != [self.sp.encode(x) for x in ("a▁ b  c", "▁a")]:
            raise ValueError("this model changes spaces before it tokenises")
        self.before = len(self.sp.encode("\n"))
        number = {c: i for i, c in enumerate(sorted({c for p in pairs for c in p}), 1)}
        self.number = np.zeros(0x110000, np.uint16 if len(number) < 1 << 16 else np.int32)  # of a character, 0 where it is in no pair
        self.number[[ord(c) for c in number]] = list(number.values())
        self.joined = np.zeros((len(number) + 1, len(number) + 1), bool)
        for p in pairs:
            self.joined[number[p[0]], number[p[1]]] = True

    def cut(self, text: str, starts: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
        """The pieces of a text, cut at `starts` as well, and the characters where they begin."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        number = self.number[codes]
        at = ~self.joined[number[:-1], number[1:]]
        begin = np.concatenate(([True], at)) if len(codes) else at
        begin[starts] = True
        begin = np.flatnonzero(begin)
        wide = np.concatenate(([0], np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF).astype(np.int8) + (codes > 0xFFFF), dtype=np.int32)))
        offsets = np.append(wide[begin], wide[-1]).astype(np.int32)
        return pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(text.encode())), begin

    def blocks(self, texts):
        """For runs of (place, text): places, pieces and the place each is of. A text longer than BLOCK comes in several runs, parted at a cut."""
        held, of, n = [], [], 0
        for place, text in texts:
            text = f" {text}".replace("▁", " ")
            while len(text) > BLOCK:
                length = BLOCK
                while True:  # up to the last cut, or farther where there is none
                    pieces, begin = self.cut(text[:length], np.empty(0, np.int64))
                    if length >= len(text) or len(begin) > 1:
                        break
                    length *= 2
                if length >= len(text):
                    break
                yield pieces.slice(0, len(begin) - 1), np.full(len(begin) - 1, place)
                text = text[begin[-1] :]
            if held and n + len(text) > BLOCK:
                yield self._block(held, of)
                held, of, n = [], [], 0
            held.append(text)
            of.append(place)
            n += len(text)
        if held:
            yield self._block(held, of)

    def _block(self, held: list[str], of: list[int]) -> tuple[pa.StringArray, np.ndarray]:
        starts = np.concatenate(([0], np.cumsum([len(t) for t in held])))
        pieces, begin = self.cut("".join(held), starts[:-1])
        return pieces, np.repeat(of, np.diff(np.append(np.searchsorted(begin, starts[:-1]), len(begin))))

    def tally(self, texts):
        for pieces, _ in self.blocks((0, t) for t in texts):
            found = pieces.value_counts()
            yield found.field("values"), found.field("counts").cast(pa.int64())

    def count(self, parts: list[str]) -> list[int]:
        """Tokens of each part, behind a line end, with which nothing merges."""
        return [len(x) - self.before for x in self.sp.encode([f"\n{p}" for p in parts], num_threads=1)]


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    """One to a Python worker, kept from task to task."""
    return PieceModel(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _counts(pieces: DataFrame, path: str) -> DataFrame:
    """pieces(piece, n) with n_tokens."""

    def run(batches):
        m = model(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(m.count(b.column(0).to_pylist()), pa.int64())], ["piece", "n", "n_tokens"])

    return pieces.mapInArrow(run, "piece string, n long, n_tokens long")


def frequencies(texts: DataFrame, path: str) -> DataFrame:
    """(_key, pieces, times) of each row of texts(_key, text)."""

    def run(batches):
        m = model(path)
        for b in batches:
            keys, rows = b.column(0), b.num_rows
            for at in range(0, rows, 512):
                part = b.slice(at, 512)
                blocks = [x for x in m.blocks(enumerate(t.as_py() for t in part.column(1)))]
                pieces = pa.chunked_array([p for p, _ in blocks], pa.string()).combine_chunks().dictionary_encode()
                of, size = np.concatenate([o for _, o in blocks]), max(1, len(pieces.dictionary))
                found, times = np.unique(of * size + pieces.indices.to_numpy(), return_counts=True)
                ends = pa.array(np.searchsorted(found, np.arange(part.num_rows + 1) * size), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, x) for x in (pieces.dictionary.take(pa.array(found % size)), pa.array(times, pa.int64()))]
                yield pa.RecordBatch.from_arrays([keys.slice(at, 512), *lists], ["_key", "pieces", "times"])

    return texts.select("_key", "text").mapInArrow(run, "_key binary, pieces array<string>, times array<long>")


def token_counts(docs: DataFrame, text_col: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """docs with text_col replaced by n_bytes (UTF-8), n_tokens and over_limit (more than `limit` tokens).

    The count is the library's for the whole text, without begin and end tokens; strings like <s> in a text are plain text. A null text
    counts as empty: no bytes, no tokens. Every row has its own result, so ids may repeat or be null, and no row is needed to be short;
    columns of docs with the new names, or called _key, are replaced. An empty table gives an empty result.

    Distinct pre-tokens are counted over all rows, tokenised once and stored; the OFTEN most frequent meet the texts' frequencies by
    broadcast, all others by a shuffle. path must lead to the model on every executor.
    """
    path = path or default_vocabulary()
    names = [c for c in docs.columns if c not in (text_col, "n_bytes", "n_tokens", "over_limit", "_key")]
    texts = segments.keyed(docs, text_col)
    pieces = stored(_counts(segments.counted(texts, partial(model, path)), path), "pieces")
    totals = segments.weighed(frequencies(texts, path), segments.often(pieces), pieces, ["n_tokens"], "frequencies")
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.when(F.length(text) > 0, F.unhex(F.md5(text.cast("binary"))))
    out = segments.met(docs.select(*names, F.octet_length(text).cast("long").alias("n_bytes"), key.alias("_key")), totals)
    return out.drop("_key").withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0))).withColumn("over_limit", F.col("n_tokens") > limit)


def op11_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op11_token_counts": op11_token_counts}
ORACLE: dict[str, str] = {}
