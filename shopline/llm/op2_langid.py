"""Language identification by cross-parsing entropy.

A suffix automaton of each language's training text accepts exactly the
strings that occur in it.  A document is parsed from left to right into the
longest phrases that the automaton follows (lower case; whatever is not a
letter counts as one blank, so that punctuation tells nothing).  Automata run
over UTF-8 bytes, so every letter of the training texts counts, whatever the
number of scripts; letters of no training text break a phrase.  The fewer phrases a language needs
(times log2 of its training length, per byte), the closer it is.  The
language with the least of these cross entropies is predicted.

Training text: per language at most ``max_chars`` characters (and ``max_total``
over all languages) of labelled documents in the order of a hash of their
text, copies counted once, the last one cut to fit.  This bound is what makes
the automata small enough to send to every task; predictions cover all whole
texts.

Parsing runs on all documents of a batch at once: texts are cut into segments
of ``SEGMENT`` bytes, each a lane of a numpy table walk, so the phrase
that a cut breaks counts twice, for every language alike.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text if there is no labelled training text; with one learned language
the score is 1; ties go to the language first in order; repeated rows get equal
results; an empty table gives an empty result; extra columns are kept unless
they have an output's name.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopline.llm.common import by_batch, decoded, residue, ship_package, stored, table

MAX_CHARS = 50_000
MAX_TOTAL = 400_000
#: Symbols are the UTF-8 bytes of letters, and bytes that no letter has.
BLANK, OTHER, PAD = 32, 1, 0
SEGMENT = 384
#: The hash bound of the training texts is found among so many bits.
BUCKET_BITS = 12


def training_sample(labelled: DataFrame, text: str, lang: str, max_chars: int = MAX_CHARS, max_total: int = MAX_TOTAL) -> DataFrame:
    """(lang, text): whole distinct texts in hash order up to the bound."""
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and length(text) > 0")
    rows = rows.withColumn("h", F.xxhash64("text"))
    # Lengths of distinct texts: copies are one row, summed up to room by bucket of the hash's upper bits.
    sizes = rows.groupBy("lang", "h").agg(F.first(F.length("text").cast("long")).alias("n"))
    sizes = sizes.groupBy("lang", F.shiftright("h", 64 - BUCKET_BITS).alias("bucket")).agg(F.sum(F.least("n", F.lit(max_chars))).alias("n"))
    sizes = stored(sizes)
    langs = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    room = sizes.select("lang").distinct().select("lang", F.least(F.lit(max_chars), (F.lit(max_total) / langs).cast("long")).alias("room"))
    # The first buckets in order that hold room: at most 2 ** BUCKET_BITS rows a language.
    before = Window.partitionBy("lang").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(room, "lang")
    last = sizes.filter("before < room").groupBy("lang").agg(F.max("bucket").alias("last"), F.first("room").alias("room"))
    # One row a language, of which there are as many as automata: small enough to send.
    rows = rows.join(F.broadcast(last), "lang").filter(F.shiftright("h", 64 - BUCKET_BITS) <= F.col("last"))
    # Cut before the shuffle: no more than room of any text is ever used.
    rows = rows.withColumn("text", F.expr("substring(text, 1, int(room))"))
    rows = rows.groupBy("lang", "h").agg(F.first("text").alias("text"), F.first("room").alias("room"))
    order = Window.partitionBy("lang").orderBy("h")
    before = F.coalesce(F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("left", F.col("room") - before).filter("left > 0")
    return rows.select("lang", "h", F.expr("substring(text, 1, int(left))").alias("text"))


def suffix_automaton(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (state, symbol, next state) of the automaton of all substrings."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in symbols:
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in nexts[p]:
            nexts[p][s] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][s]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(s) == q:
                    nexts[p][s] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    edges = [(a, s, b) for a, to in enumerate(nexts) for s, b in to.items()]
    a = np.array(edges, np.int32).reshape(-1, 3)
    return a[:, 0].copy(), a[:, 1].astype(np.uint8), a[:, 2].copy()


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([i for i in range(0x110000) if chr(i).isalpha()])


def symbol_table(alphabet: list[str]) -> np.ndarray:
    """What every code point counts as: itself if a known letter, another letter, or a blank for all else."""
    lut = np.full(0x110000, BLANK, np.uint32)
    lut[_letters()] = OTHER
    known = np.array([ord(c) for c in alphabet], np.int64)
    lut[known] = known
    return lut


def to_symbols(text: str, lut: np.ndarray) -> np.ndarray:
    """Bytes of the lower-cased text; a run of characters that aren't letters is one blank."""
    s = lut[np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")]
    blank = s == BLANK
    blank[1:] &= s[:-1] == BLANK
    blank[:1] = False
    return np.frombuffer(s[~blank].astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", max_chars: int = MAX_CHARS,
          max_total: int = MAX_TOTAL) -> dict:
    """The model: alphabet, languages, their training lengths and automata (bounded, on the driver)."""
    ship_package(labelled.sparkSession)
    sample = training_sample(labelled, text, lang, max_chars, max_total)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("h")
        letters = sorted({c for t in group["text"] for c in t.lower() if c.isalpha()})
        lut = symbol_table(letters)
        symbols = [s for t in group["text"] for s in [*to_symbols(t, lut).tolist(), OTHER]]
        a, s, b = suffix_automaton(symbols)
        return pd.DataFrame([{"lang": group["lang"].iloc[0], "letters": "".join(letters), "chars": len(symbols),
                              "a": a.tobytes(), "s": s.tobytes(), "b": b.tobytes()}])

    rows = sample.groupBy("lang").applyInPandas(build, "lang string, letters string, chars long, a binary, s binary, b binary").collect()
    rows.sort(key=lambda r: r.lang)
    return {"alphabet": sorted({c for r in rows for c in r.letters}), "langs": [r.lang for r in rows], "chars": [r.chars for r in rows],
            "edges": [(bytes(r.a), bytes(r.s), bytes(r.b)) for r in rows]}


class Parser:
    """Counts phrases of many texts at once, for every language of a model.

    ``step[state + column]`` is four times the next state's offset, plus the
    phrases that ended.  All languages share one table; each has a root of its
    own, and columns for the bytes of its own training text only (``columns``).
    """

    def __init__(self, model: dict):
        self.lut = symbol_table(model["alphabet"])
        self.langs = model["langs"]
        self.weight = np.log2(np.maximum(2, np.array(model["chars"], float)))
        tables, roots, base = [], [], 0
        self.columns = np.zeros((len(self.langs), 256), np.int64)  # column 0: bytes that the language lacks
        for mine, (a, s, b) in zip(self.columns, model["edges"], strict=True):
            a, s, b = np.frombuffer(a, np.int32), np.frombuffer(s, np.uint8), np.frombuffer(b, np.int32)
            states = int(max(a.max(initial=0), b.max(initial=0))) + 1
            used = np.setdiff1d(s, [OTHER, PAD])
            width = len(used) + 2
            pad = width - 1
            mine[used] = np.arange(1, pad)
            mine[PAD] = pad
            own = np.full((states, width), -1, np.int64)
            own[a, mine[s]] = b
            own[:, 0] = -1  # no phrase goes over a letter outside the alphabet
            first = np.where(own[0] >= 0, own[0], 0)  # where a new phrase that begins with a symbol leads
            ends = own < 0
            go = np.where(ends, first[None, :], own)
            flag = ends.astype(np.int64)
            flag[0] = 0
            alone = own[0] < 0  # a symbol that the language lacks is a phrase by itself
            flag[:, alone] += 1
            flag[:, pad] = 1
            flag[0, pad] = 0
            table = (go * width + base) << 2 | flag
            base += states * width
            # Kept narrow while the tables of other languages are made.
            tables.append(table.astype(np.int32 if base < 1 << 29 else np.int64).ravel())
            roots.append(base - states * width)
        self.step = np.concatenate(tables) if tables else np.zeros(0, np.int64)
        self.roots = np.array(roots, self.step.dtype)
        self.columns = self.columns.astype(self.step.dtype)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrase counts (text x language) and lengths."""
        symbols = [to_symbols(t, self.lut) for t in texts]
        length = np.array([len(s) for s in symbols], np.int64)
        lanes = -(-length // SEGMENT)
        total = np.zeros((len(texts), len(self.langs)), np.int64)
        if not lanes.sum():
            return total, length
        cut = np.full((int(lanes.sum()), SEGMENT + 1), PAD, np.uint8)
        flat, at = cut[:, :SEGMENT], 0
        for s, n in zip(symbols, lanes, strict=True):
            whole = len(s) // SEGMENT
            flat[at:at + whole] = s[:whole * SEGMENT].reshape(whole, SEGMENT)
            if whole < n:
                flat[at + whole, :len(s) - whole * SEGMENT] = s[whole * SEGMENT:]
            at += n
        columns = np.ascontiguousarray(cut.T)
        state = np.repeat(self.roots[:, None], cut.shape[0], 1)
        count = np.zeros(state.shape, np.int64 if self.step.dtype == np.int64 else np.int32)
        for column in columns:
            state += self.columns[:, column]
            state = self.step[state]
            count += state & 3
            state >>= 2
        ends = np.cumsum(lanes)
        sums = np.concatenate([np.zeros((len(self.langs), 1), np.int64), np.cumsum(count, 1, dtype=np.int64)], 1)
        return (sums[:, ends] - sums[:, ends - lanes]).T, length

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score (0 to 1: how much less the best needs than the next)."""
        counts, length = self.phrases(texts)
        lang, score = [], []
        for text, row, n in zip(texts, counts, length, strict=True):
            if not n or not self.langs or not any(map(str.isalpha, text)):
                lang.append("und")
                score.append(0.0)
                continue
            bits = row * self.weight / n
            best = int(np.argmin(bits))
            rest = np.delete(bits, best)
            lang.append(self.langs[best])
            score.append(float(1 - bits[best] / rest.min()) if len(rest) and rest.min() > 0 else 1.0 - float(len(rest) > 0))
        return lang, score


def predict(df: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add lang_pred and score.  A document with lang_pred ``und`` is rejected."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in (keep if keep is not None else df.columns) if c not in ("lang_pred", "score")]
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + ["lang_pred string, score double"])

    def make():
        parser = Parser(sent.value)

        def step(batch: pa.RecordBatch) -> dict:
            lang, score = parser.predict(decoded(batch.column(len(keep))))
            return {c: batch.column(i) for i, c in enumerate(keep)} | {"lang_pred": lang, "score": score}

        return step

    return by_batch(df, [F.col(f"`{c}`") for c in keep] + [F.col(f"`{text}`").cast("binary").alias("__text")], schema, make)


def held_out(doc_id: str = "doc_id"):
    """Documents whose labels are not learned from (a null id is not held out)."""
    return F.coalesce(residue(F.col(doc_id), 3) == 1, F.lit(False))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.filter(~held_out()))
    return predict(docs, model, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
