"""Byte-level BPE encoding and decoding in linear time.

A piece's bytes, read as Latin-1 text, are looked up in an Aho-Corasick
automaton of the whole vocabulary for the longest token at a position.  The
encoder walks left to right with the longest token that can stand beside the
token before it, takes shorter ones where it can't, and steps back where none
can; a position that once proved a dead end is not entered again, so the work
stays linear in the piece.  Whether two tokens can stand side by side is
decided by undoing their merges from the last to the first and asking whether
a merge across the border would have come earlier; the answers are memoised.

Edge cases: null and empty texts give no ids; bytes that are not UTF-8 are
replaced by U+FFFD before encoding (as a text API would); long texts are cut
into pieces by the pattern as a stream; repeated rows give repeated results;
an empty table gives an empty table; extra columns are kept unless a name
equals an output column, which is then replaced.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopline.llm.common import by_batch, decoded, table

#: Entries that each of a worker's two growing memo tables holds before it starts anew: of pieces of at
#: most LONGEST characters and of pairs of tokens, some 50 MB a table.
MEMO, LONGEST = 1 << 18, 64
#: Texts beyond so many characters are matched as a stream, not as one list.
STREAM = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 token and rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class BytePairs:
    """Encoder of single pieces of bytes for one table of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.size_of = {r: len(b) for b, r in ranks.items()}
        self.trie = ahocorasick.Automaton()
        self.of_latin = {b.decode("latin-1"): r for b, r in ranks.items()}
        for word, r in self.of_latin.items():
            self.trie.add_word(word, r)
        self.trie.make_automaton()
        self.reach = max(map(len, ranks), default=0)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.shorter: dict[int, int | None] = {}
        self.beside: dict[tuple[int, int], bool] = {}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self.halves:
            self.halves[token] = self._last_merge(self.bytes_of[token])
        return self.halves[token]

    def _last_merge(self, word: bytes) -> tuple[int, int] | None:
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > 2:
            ranked = [(self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(ranked)
            if rank == 1 << 60:
                raise ValueError(f"token {word!r} can't be reached by merges")
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def _shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if token not in self.shorter:
            b = self.bytes_of[token]
            self.shorter[token] = next((r for n in range(len(b) - 1, 0, -1) if (r := self.ranks.get(b[:n])) is not None), None)
        return self.shorter[token]

    def _longest(self, word: str, at: int) -> int:
        """The longest token that begins at a position: the automaton says how
        far any token's path goes, the longest whole token ends there or before."""
        ahead = word[at:at + self.reach]
        size = self.trie.longest_prefix(ahead)
        while (token := self.of_latin.get(ahead[:size])) is None:
            size -= 1
        return token

    def can_adjoin(self, left: int, right: int) -> bool:
        """True if merging the joined bytes leaves the border where it is."""
        key = (left, right)
        known = self.beside.get(key)
        if known is None:
            if len(self.beside) >= MEMO:
                self.beside.clear()
            known = self.beside[key] = self._can_adjoin(left, right)
        return known

    def _can_adjoin(self, left: int, right: int) -> bool:
        # `a` ends at the border and `b` starts there.  Each was whole until it
        # merged into its parent at the parent's rank; a pair (a, b) of lower
        # rank would have merged over the border before.  Between equal ranks
        # the pair further left goes first: the border's pair is right of a's
        # own merge and left of b's.
        a, b = left, right
        a_until = b_until = 1 << 60
        while True:
            across = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if across is not None and across < a_until and across <= b_until:
                return False
            # Undo whichever of the two merges came later.
            ha, hb = self._halves(a), self._halves(b)
            if ha is None and hb is None:
                return True
            if hb is None or (ha is not None and a > b):
                a_until, a = a, ha[1]
            else:
                b_until, b = b, hb[0]
            # The older limit of the other side still holds: it is whole for longer.

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        word, n = piece.decode("latin-1"), len(piece)
        size_of, beside = self.size_of, self.beside
        out: list[int] = []
        dead: set[int] = set()
        at, token, before = 0, self._longest(word, 0), -1
        while at < n:
            end = at + size_of[token]
            if end not in dead:
                if before < 0:
                    fits = True
                elif (fits := beside.get((before, token))) is None:
                    fits = self.can_adjoin(before, token)
                if fits:
                    out.append(token)
                    before, at = token, end
                    if at < n:
                        token = self._longest(word, at)
                    continue
            smaller = self._shorter(token)
            if smaller is None:  # nothing can start here after what stands before
                dead.add(at)
                token = out.pop()
                at -= size_of[token]
                before = out[-1] if out else -1
            else:
                token = smaller
        return out


def little_endian(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Pieces(dict):
    """Piece of text to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, pairs: BytePairs):
        self.pairs = pairs

    def __missing__(self, piece: str) -> bytes:
        ids = little_endian(self.pairs.encode(piece.encode("utf-8")))
        if len(piece) <= LONGEST:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def _pieces(path: str) -> _Pieces:
    """One encoder and memo for a worker process: reused by its later tasks."""
    return _Pieces(BytePairs(read_ranks(path)))


@lru_cache(maxsize=2)
def _bytes_of(path: str) -> list[bytes]:
    known = {r: b for b, r in read_ranks(path).items()}
    return [known.get(i, b"") for i in range(max(known, default=-1) + 1)]


def _encoder(path: str, pattern: str):
    import regex

    find, pieces = regex.compile(pattern), _pieces(path)

    def encode(text: str) -> bytes:
        if len(text) <= STREAM:
            return b"".join(map(pieces.__getitem__, find.findall(text)))
        found, out = (m.group() for m in find.finditer(text)), []
        while block := list(islice(found, 100_000)):
            out.append(b"".join(map(pieces.__getitem__, block)))
        return b"".join(out)

    return encode


def _mapped(df: DataFrame, source: Column, made: list[str], keep: list[str] | None, make: Callable[[], Callable[[pa.Array], list[list]]]) -> DataFrame:
    """The kept columns, and binary columns that ``make``'s function gives for the values of ``source``."""
    keep = [c for c in (keep or df.columns) if c not in made]
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"`{c}` binary" for c in made])

    def start():
        of = make()

        def step(batch: pa.RecordBatch) -> dict:
            values = of(batch.column(len(keep)))
            return {c: batch.column(i) for i, c in enumerate(keep)} | {c: pa.array(v, pa.binary()) for c, v in zip(made, values, strict=True)}

        return step

    return by_batch(df, [F.col(f"`{c}`") for c in keep] + [source.cast("binary").alias("__value")], schema, start)


def _joined(of: list[bytes], ids: bytes | None) -> bytes:
    return b"".join(map(of.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """Add ``ids``: the text's tokens as little-endian unsigned 32-bit integers
    in one binary value, special tokens excluded.

    ``ranks`` is the vocabulary file's path on the workers, ``pattern`` the
    regular expression whose matches are encoded one by one.
    """
    def make():
        one = _encoder(ranks, pattern)
        return lambda texts: [[one(t) for t in decoded(texts)]]

    return _mapped(df, F.col(f"`{text}`"), [ids], keep, make)


def decode(df: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """Add ``out``: the bytes of the ids (null ids: no bytes)."""
    def make():
        of = _bytes_of(ranks)
        return lambda values: [[_joined(of, v) for v in values.to_pylist()]]

    return _mapped(df, F.col(f"`{ids}`"), [out], keep, make)


def round_trip(df: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded",
               keep: list[str] | None = None) -> DataFrame:
    """:func:`encode` and :func:`decode` of its ids in one pass, so that a core has one Python worker."""
    def make():
        one, of = _encoder(ranks, pattern), _bytes_of(ranks)

        def both(texts: pa.Array) -> list[list]:
            coded = [one(t) for t in decoded(texts)]
            return [coded, [_joined(of, v) for v in coded]]

        return both

    return _mapped(df, F.col(f"`{text}`"), [ids, out], keep, make)


def n_tokens(ids: str = "ids"):
    return (F.octet_length(ids) / 4).cast("long")


def vocabulary() -> tuple[str, str]:
    """Path and pattern of the default vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: token count and digests of ids and decoded bytes."""
    ranks, pattern = vocabulary()
    both = round_trip(table(spark, sf_dir, "documents"), ranks, pattern, keep=["doc_id"])
    return both.select("doc_id", n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
