"""Subword lattice likelihood: the probability of a text over all segmentations.

The pieces are those of an existing subword vocabulary; their unigram scores
are estimated from the training documents (piece counts of every training
word).  No piece spans a blank, so the lattice of a document falls apart at
its words, and a word's marginal needs to be computed only once however often
the word occurs:

1. count every word of all documents (map-side counts, one row a word);
2. segment each distinct training word once for the piece counts, whose sum
   has at most as many rows as the vocabulary;
3. for each distinct word, forward recursion in log space over all its
   segmentations (:func:`word_log10`);
4. per document, sum count * log10 over its words.  The ``HOT`` most frequent
   words (a fixed number) travel to the tasks as a table, so neither a very
   frequent word nor most of the tokens are shuffled; all others are joined.

Edge cases: a null or empty text has only its end token; words that are not
UTF-8 are scored with U+FFFD for the bad bytes; characters outside the
vocabulary are spelled by its byte pieces; rows with equal or null ids are
scored one by one; a null id counts as training; without training documents
all piece scores are equal; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopline.llm.common import by_stream, drop, residue, stored, table

#: Words that the tasks of the scoring pass hold with their scores.
HOT = 1 << 16
#: Distinct words that a counting task holds before it passes them on.
HELD = 300_000
#: Added to each piece's count.
ALPHA = 0.1


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def count_words(df: DataFrame, text: str, train: str) -> DataFrame:
    """(word, n): occurrences in training rows of every word of all rows (0: in others only)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known, other = Counter(), set()

        def out() -> dict:
            words = list(known) + [w for w in other if w not in known]
            return {"word": words, "n": [known.get(w, 0) for w in words]}

        for batch in batches:
            texts = batch.column(0).to_pylist()
            flags = batch.column(1).to_pylist()
            for value, trains in zip(texts, flags, strict=True):
                words = (value or b"").lower().split()
                known.update(words) if trains else other.update(words)
            if len(known) + len(other) > HELD:
                yield out()
                known, other = Counter(), set()
        yield out()

    counted = by_stream(df, [F.col(f"`{text}`").cast("binary"), F.col(f"`{train}`")], "word binary, n long", count)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def count_pieces(words: DataFrame, model: str) -> DataFrame:
    """(piece, n): how often each piece id stands in the training words' segmentations."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        total = np.zeros(pieces.get_piece_size())
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            ids = pieces.encode(words, num_threads=1)
            times = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), [len(i) for i in ids])
            total += np.bincount(np.fromiter((p for i in ids for p in i), np.int64, len(times)), times, len(total))
        at = np.flatnonzero(total)
        yield {"piece": at, "n": total[at]}

    counted = by_stream(words, [F.col("word"), F.col("n")], "piece int, n double", count)
    return counted.groupBy("piece").agg(F.sum("n").alias("n"))


def piece_kinds(vocab) -> list[str]:
    """``text``, ``byte`` or ``special`` for every piece of a vocabulary, by its type there."""
    special = lambda i: vocab.is_unknown(i) or vocab.is_control(i) or vocab.is_unused(i)
    return ["byte" if vocab.is_byte(i) else "special" if special(i) else "text" for i in range(vocab.get_piece_size())]


def _kind_by_name(piece: str) -> str:
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return "byte"
    return "special" if piece in ("<unk>", "<s>", "</s>", "<pad>") else "text"


class Lattice:
    """Piece scores (natural logarithms) and the forward recursion over them."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str] | None = None):
        """``kinds`` as of :func:`piece_kinds`; without it, only what looks like a byte or special piece is one."""
        import ahocorasick

        self.trie, self.byte, self.single = ahocorasick.Automaton(), {}, set()
        for piece, score, kind in zip(pieces, scores, kinds or [_kind_by_name(p) for p in pieces], strict=True):
            if kind == "byte":
                self.byte[int(piece[3:5], 16)] = score
            elif piece and kind == "text":
                self.trie.add_word(piece, (len(piece), score))
                if len(piece) == 1:
                    self.single.add(piece)
        self.trie.make_automaton()

    def word_log10(self, word: str) -> float:
        """log10 of the summed probability of all segmentations of a word with its leading blank."""
        chars = "▁" + word
        ends: list[list[tuple[int, float]]] = [[] for _ in range(len(chars) + 1)]
        for end, (size, score) in self.trie.iter(chars):
            ends[end + 1].append((end + 1 - size, score))
        for i, c in enumerate(chars):
            if c not in self.single:
                ends[i + 1].append((i, sum(self.byte[b] for b in c.encode("utf-8", "replace"))))
        log = [0.0] * (len(chars) + 1)
        for j in range(1, len(log)):
            arcs = [log[i] + score for i, score in ends[j]]
            top = max(arcs)
            log[j] = top if len(arcs) == 1 else top + math.log(sum([math.exp(a - top) for a in arcs]))
        return log[-1] / math.log(10)


def piece_scores(pieces: list[str], counts: dict[int, float], ends: int, alpha: float = ALPHA) -> tuple[list[float], float]:
    """Natural log probabilities of the pieces, and that of the end of a text."""
    total = sum(counts.values()) + ends + alpha * (len(pieces) + 1)
    return [math.log((counts.get(i, 0) + alpha) / total) for i in range(len(pieces))], math.log((ends + alpha) / total)


def score_words(words: DataFrame, pieces: list[str], scores: list[float], kinds: list[str] | None = None) -> DataFrame:
    """Add lattice: log10 of the word's marginal probability."""
    sent = words.sparkSession.sparkContext.broadcast((pieces, scores, kinds))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        lattice = Lattice(*sent.value)
        for batch in batches:
            words = batch.column(0)
            yield {"word": words, "n": batch.column(1),
                   "lattice": [lattice.word_log10(w.decode("utf-8", "replace")) for w in words.to_pylist()]}

    return by_stream(words, [F.col("word"), F.col("n")], "word binary, n long, lattice double", score)


def score(df: DataFrame, doc_id: str, text: str, train: str, model: str) -> DataFrame:
    """One row per row of ``df``: doc_id, train, n_tokens, n_known,
    train_tokens, base_score and score (log10)."""
    import sentencepiece

    spark = df.sparkSession
    rows = df.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text"), F.col(f"`{train}`").alias("__train"))
    words = stored(count_words(rows, "__text", "__train"))
    n_train = rows.filter("__train").count()
    seen, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    train_tokens, vocabulary = seen + n_train, distinct + (n_train > 0)

    vocab = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [vocab.id_to_piece(i) for i in range(vocab.get_piece_size())]
    counts = {r.piece: r.n for r in count_pieces(words.filter("n > 0"), model).collect()}  # a row a piece at most
    scores, end = piece_scores(pieces, counts, n_train)
    scored = stored(score_words(words, pieces, scores, piece_kinds(vocab)))
    drop(words)
    hot = {bytes(r.word): (math.log10(r.n + 0.1), r.lattice, r.n > 0)
           for r in scored.orderBy(F.desc("n"), "word").limit(HOT).collect()}
    sent = spark.sparkContext.broadcast(hot)

    schema = "row long, id_of long, train boolean, tokens long, known long, base double, lattice double, word binary, times long"

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hot = sent.value
        names = [c.split(" ")[0] for c in schema.split(", ")]
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            row, ids, train, tokens, known, base, lattice, word, times = out.values()
            for key, doc, value, trains in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                found = Counter((value or b"").lower().split())
                b = m = 0.0
                k, rest = 0, []
                for w, n in found.items():
                    if s := hot.get(w):
                        b += n * s[0]
                        m += n * s[1]
                        k += n * s[2]
                    else:
                        rest.append((w, n))
                more = len(rest)
                row += [key] * (1 + more)
                ids += [doc] + [None] * more
                train += [bool(trains)] + [None] * more
                tokens += [sum(found.values()) + 1] + [0] * more
                known += [k] + [0] * more
                base += [b] + [0.0] * more
                lattice += [m] + [0.0] * more
                word += [None] + [w for w, _ in rest]
                times += [0] + [n for _, n in rest]
            yield out

    cols = [F.monotonically_increasing_id(), F.col("__id").cast("long"), F.col("__text").cast("binary"), F.col("__train")]
    parts = by_stream(rows, cols, schema, lookup)
    # 96 bits of hash stand for a word in the shuffle; a document's own row has a key that no word has.
    is_word = F.col("word").isNotNull()
    parts = parts.withColumns({"h1": F.when(is_word, F.xxhash64("word")).otherwise(F.xxhash64("row")),
                               "h2": F.when(is_word, F.hash("word").cast("long")).otherwise(F.lit(1 << 40))}).drop("word")
    rare = scored.select(F.xxhash64("word").alias("h1"), F.hash("word").cast("long").alias("h2"),
                         F.col("n").alias("c"), F.col("lattice").alias("marginal"))
    joined = parts.join(rare, ["h1", "h2"], "left")
    total = joined.groupBy("row").agg(
        F.max("id_of").alias("doc_id"), F.max("train").alias("train"), F.sum("tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.coalesce(F.col("times") * F.log10(F.col("c") + 0.1), F.lit(0.0))).alias("base"),
        F.sum(F.col("lattice") + F.coalesce(F.col("times") * F.col("marginal"), F.lit(0.0))).alias("marginal"))
    end_base = math.log10(n_train + 0.1)
    norm = math.log10(train_tokens + 0.1 * (vocabulary + 1))
    return total.select("doc_id", "train", "n_tokens", (F.col("n_known") + int(n_train > 0)).alias("n_known"),
                        F.lit(train_tokens).cast("long").alias("train_tokens"),
                        (F.col("base") + end_base - F.col("n_tokens") * norm).alias("base_score"),
                        (F.col("marginal") + end / math.log(10)).alias("score"))


def op3_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token counts, add-0.1 unigram score and lattice score (log10)."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", (F.coalesce(residue(F.col("doc_id"), 10), F.lit(1)) != 0).alias("train"))
    out = score(docs, "doc_id", "text", "train", piece_model())
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
