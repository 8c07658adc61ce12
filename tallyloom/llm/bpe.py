"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece there is exactly one token that ends its encoding and goes with what stands before: the table `last` keeps
it. A token may follow another if encoding the bytes of both gives the two back. The table gives the encoding of every prefix, so
appending bytes only adds entries, and after an edit only entries from the first changed byte on are computed again.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import table, text_or_empty

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pieces that a worker remembers, twice: beyond that it forgets those it has not met since it last forgot. Token pairs likewise, all at once.
PIECES, PAIRS = 300_000, 1_000_000


class Vocabulary:
    """Ranks of byte strings, and which token may follow which."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {r: b for b, r in ranks.items()}
        self.follows: dict[int, bool] = {}
        alone = {r: self._merge(b) == [r] for b, r in ranks.items() if len(b) > 1}
        self.usable = {b: r for b, r in ranks.items() if alone.get(r, True)}
        self.size = {r: len(b) for b, r in self.usable.items()}
        self._link()

    def _link(self) -> None:
        """Suffix links over the tokens' bytes: `step` and `fail` lead to the longest token prefix that ends at a byte, `longest` to the
        longest token that ends there, and `shorter` from a token to the next shorter one that ends with it."""
        step: dict[int, int] = {}
        token, fail, order = [-1], [0], []
        for b, r in self.usable.items():
            at = 0
            for x in b:
                if (to := step.get(at << 8 | x)) is None:
                    to = step[at << 8 | x] = len(token)
                    token.append(-1)
                    order.append((len(token) - 1, at, x))
                at = to
            token[at] = r
        fail = [0] * len(token)
        below: dict[int, list[tuple[int, int]]] = {}
        for to, at, x in order:
            below.setdefault(at, []).append((x, to))
        longest, queue = [-1] * len(token), [0]
        self.shorter: dict[int, int] = {}
        for at in queue:
            for x, to in below.get(at, ()):
                f = fail[at]
                while at and (f << 8 | x) not in step and f:
                    f = fail[f]
                fail[to] = step.get(f << 8 | x, 0) if at else 0
                inner = longest[fail[to]]
                longest[to] = token[to] if token[to] >= 0 else inner
                if token[to] >= 0:
                    self.shorter[token[to]] = inner
                queue.append(to)
        self.step, self.fail, self.longest = step, fail, longest

    def _merge(self, piece: bytes) -> list[int]:
        """Merges of lowest rank first, leftmost first: the definition, used on one or two tokens' bytes."""
        ranks, parts = self.ranks, [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def may_follow(self, a: int, b: int) -> bool:
        key = a << 32 | b
        if (known := self.follows.get(key)) is None:
            if len(self.follows) >= PAIRS:
                self.follows.clear()
            both = self.bytes[a] + self.bytes[b]
            known = self.follows[key] = both not in self.usable and self._merge(both) == [a, b]
        return known


class PrefixEncoder:
    """The encoding of every prefix of one piece's bytes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.v, self.piece, self.last, self.state = vocabulary, b"", [-1], [0]
        self.append(piece)

    def append(self, more: bytes) -> "PrefixEncoder":
        """Exact: the entries of the bytes already there stay."""
        v, last, state = self.v, self.last, self.state
        step, fail, longest, shorter, size, follows, may = v.step.get, v.fail, v.longest, v.shorter, v.size, v.follows.get, v.may_follow
        end, at = len(self.piece), state[-1]
        self.piece += more
        for x in more:
            end += 1
            while (to := step(at << 8 | x)) is None:
                at = fail[at]
            at, t = to, longest[to]
            while (p := last[end - size[t]]) >= 0 and not (may(p, t) if (ok := follows(p << 32 | t)) is None else ok):
                t = shorter[t]
            last.append(t)
            state.append(at)
        return self

    def edit(self, start: int, end: int, new: bytes) -> "PrefixEncoder":
        """Replace bytes start..end: entries before `start` are kept, those after are computed again."""
        tail = new + self.piece[end:]
        self.piece, self.last, self.state = self.piece[:start], self.last[: start + 1], self.state[: start + 1]
        return self.append(tail)

    def ids(self, end: int | None = None) -> list[int]:
        """Token ids of the prefix of `end` bytes, by default of all."""
        out, at = [], len(self.piece) if end is None else end
        while at:
            out.append(t := self.last[at])
            at -= len(self.v.bytes[t])
        return out[::-1]


class Tokenizer:
    """Pieces by a pattern, each encoded by itself; keeps the ids of pieces seen before."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.v = Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a})
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        top = max(self.v.bytes) + 1
        self.table = [self.v.bytes.get(i, b"") for i in range(top)]

    def _piece(self, piece: str) -> bytes:
        if (ids := self.older.get(piece)) is None:
            raw = piece.encode("utf-8", "surrogatepass")
            whole = self.v.ranks.get(raw)
            ids = pack("<I", whole) if whole is not None else array("I", PrefixEncoder(self.v, raw).ids()).tobytes()
        if len(piece) <= 64:
            if len(self.known) >= PIECES:
                self.known, self.older = {}, self.known
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        out, new = [], self._piece
        pieces = self.split(text)
        for at in range(0, len(pieces), 4096):
            known = self.known.get
            out += [known(p) or new(p) for p in pieces[at : at + 4096]]
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> Tokenizer:
    """One to a Python worker, kept from task to task."""
    return Tokenizer(path, pattern)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def _map(docs: DataFrame, text_col: str, path: str | None, pattern: str | None, fields: str, out):
    given = default_vocabulary() if path is None or pattern is None else (path, pattern)
    path, pattern = path or given[0], pattern or given[1]

    def run(batches):
        t = tokenizer(path, pattern)
        for b in batches:
            for part in (b.slice(i, 256) for i in range(0, b.num_rows, 256)):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *out(t, part.column(part.num_columns - 1))], [*names, *more])

    names, more = [c for c in docs.columns if c != text_col], [x.split()[0] for x in fields.split(", ")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text_col)
    return docs.select(*names, text_or_empty(text_col).alias("_text")).mapInArrow(run, f"{schema}, {fields}")


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """docs with text_col replaced by token_ids (array of int) and n_tokens. A null text counts as empty: no ids. No special tokens.

    path and pattern give the rank file and the pattern that splits texts, by default the public multilingual vocabulary's. Every row is
    encoded by itself, whole; columns of docs called token_ids or n_tokens are replaced.
    """

    def out(t, texts):
        ids = [t.encode(x.as_py()) for x in texts]
        return [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64())]

    return _map(docs.drop("token_ids", "n_tokens"), text_col, path, pattern, "token_ids array<int>, n_tokens long", out)


def round_trip(docs: DataFrame, text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """docs with text_col replaced by n_tokens and the digests of its ids (little-endian unsigned 32-bit) and of the bytes they decode to."""

    def out(t, texts):
        ids = [t.encode(x.as_py()) for x in texts]
        sha = lambda of: pa.array([hashlib.sha256(x).hexdigest() for x in of], pa.string())
        return [pa.array([len(x) for x in ids], pa.int64()), sha(x.tobytes() for x in ids), sha(t.decode(x) for x in ids)]

    return _map(docs.drop("n_tokens", "ids_sha256", "decoded_sha256"), text_col, path, pattern, "n_tokens long, ids_sha256 string, decoded_sha256 string", out)


def op10_byte_bpe(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op10_byte_bpe": op10_byte_bpe}
ORACLE: dict[str, str] = {}
