"""Spelling variants: exact neighbours at one edit by PartEnum signatures.

A word's letters are a binary vector: one dimension for the first, second, ...
occurrence of each letter.  One inserted or deleted letter changes one
dimension, a replaced one two, so near words have a Hamming distance of at most
two.  The letters are dealt to ``PARTS`` parts; of two vectors at distance two
at most, all parts but two are equal.  A signature is a choice of PARTS - 2
parts with the word's letters in them: near words share a signature for sure.

1. Runs of letters are counted over all texts, combined map-side.
2. Each word is a row per signature, joined on it with the words of its own
   length and, as ``up`` rows, with those one letter longer.  Words from few
   syllables share many letters, so the key has one more exact condition: the
   one edit leaves the first or the second half of the shorter word as it is,
   and each signature comes once with either half.  A pair is taken at the
   first signature and half that both share, so it comes out of the join once.
3. ``levenshtein`` verifies the pair in the join.
4. Words follow their forms to the last one by pointer doubling.

Edge cases: null and empty texts have no words; a null id counts as an empty
id; a text of any length is read whole; repeated rows count once each; equal
counts go to the word first in code-point order; an empty table gives an empty
result; extra columns take no part.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopline.llm.common import UPPER, drop, lower_ascii, stored, table

#: Parts that the letters are dealt to; signatures are all choices of PARTS - 2 of them.
PARTS = 4
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: Fixed value: a run in these many loses a letter.
SLIP = 199
#: Bits of a part's hash in the packed parts of a word.
BITS = 64 // PARTS


def runs(docs: DataFrame, doc_id: str, text: str, min_length: int) -> DataFrame:
    """(word): the runs of at least ``min_length`` letters of all texts, some with a letter gone."""
    # Shorter runs can't make a word; a longer one always begins where a match does.
    found = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[A-Za-zÀ-ÿ]{{{min_length},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), found.alias("run"))
    rows = rows.withColumn("run", F.when(F.col("run").rlike(f"[{UPPER[0]}-{UPPER[-1]}]"), lower_ascii(F.col("run"))).otherwise(F.col("run")))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return rows.select(F.when(F.col("h") % SLIP == 0, word).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that occur often enough."""
    words = runs(docs, doc_id, text, min_length).filter(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def dealt(words: DataFrame) -> list[str]:
    """The alphabet in PARTS strings, dealt back and forth by frequency.

    Any dealing is right; an even one makes the signatures tell words apart.
    The alphabet is at most the pattern's letters, so it fits the driver.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    order = [r["c"] for r in letters.orderBy(F.desc("n"), "c").collect()]
    parts = [""] * PARTS
    for i, c in enumerate(order):
        turn, place = divmod(i, PARTS)
        parts[place if turn % 2 == 0 else PARTS - 1 - place] += c
    return parts


def _packed(parts: list[str]) -> Column:
    """Hashes of the sorted letters of each part, BITS bits each, in one long."""
    letters = F.concat_ws("", F.array_sort(F.split("word", "")))
    out = F.lit(0).cast("long")
    for j in range(PARTS):
        others = "".join(p for k, p in enumerate(parts) if k != j)
        own = F.xxhash64(F.translate(letters, others, "")).bitwiseAND(F.lit((1 << BITS) - 1))
        out = out.bitwiseOR(F.shiftleft(own, BITS * j))
    return out


CHOICES = list(combinations(range(PARTS), PARTS - 2))


def _mask(choice: tuple[int, ...]) -> Column:
    """The bits of the chosen parts."""
    bits = sum(((1 << BITS) - 1) << (BITS * j) for j in choice)
    return F.lit(bits - (1 << 64) if bits >= 1 << 63 else bits).cast("long")


def signatures(words: DataFrame, parts: list[str]) -> DataFrame:
    """(key, sig, up, word, n, parts): a row per signature, half and length to meet in.

    ``up`` rows are those in which a word is the longer one.
    """
    rows = words.withColumn("parts", _packed(parts))
    size, made = F.length("word"), []
    for up in (False, True):
        short = size - 1 if up else size
        half = F.floor(short / 2).cast("int")
        first, second = F.substring("word", F.lit(1), half), F.substring("word", half + (2 if up else 1), size)
        for i, choice in enumerate(CHOICES):
            kept = F.col("parts").bitwiseAND(_mask(choice))
            for h, piece in enumerate((first, second)):
                sig = 2 * i + h
                made.append(F.struct(F.xxhash64(F.lit(sig), kept, short, piece).alias("key"), F.lit(sig).cast("byte").alias("sig"), F.lit(up).alias("up")))
    rows = rows.withColumn("s", F.explode(F.array(*made)))
    return rows.select("s.key", "s.sig", "s.up", "word", "n", "parts")


def _first_choice(x: Column) -> Column:
    """Of two words whose packed parts differ by ``x``: their first shared choice."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(CHOICES))):
        out = F.when(x.bitwiseAND(_mask(CHOICES[i])) == 0, F.lit(i)).otherwise(out)
    return out


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all pairs at one edit, each once; the longer
    word, or of equal lengths the later one, is ``other``."""
    rows = signatures(words, dealt(words))
    a, b = rows.filter(~F.col("up")).drop("up").alias("a"), rows.alias("b")
    left, right = F.col("a.word"), F.col("b.word")
    size = F.length(left)
    half = F.floor(size / 2).cast("int")
    same_start = F.substring(left, F.lit(1), half) == F.substring(right, F.lit(1), half)
    met = F.when(F.col("b.up"), F.length(right) == size + 1).otherwise((F.length(right) == size) & (left < right))
    first = 2 * _first_choice(F.col("a.parts").bitwiseXOR(F.col("b.parts"))) + F.when(same_start, 0).otherwise(1)
    near = F.levenshtein(left, right, 1) == 1
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.sig") == F.col("b.sig")) & met & near & (first == F.col("a.sig")))
    return pairs.select(left.alias("word"), F.col("a.n").alias("n"), right.alias("other"), F.col("b.n").alias("other_n"))


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): each word with its most frequent near word, if that is frequent enough."""
    ends = F.explode(F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                                                                F.col("word").alias("other"), F.col("n").alias("other_n"))))
    both = near_pairs(words).select(ends.alias("e")).select("e.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w"))).alias("best"))
    rows = words.join(best, "word", "left").withColumn("enough", -F.col("best.m") >= ratio * F.col("n"))
    return rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                       F.when(F.col("enough"), F.col("best.w")).alias("form"), F.when(F.col("enough"), -F.col("best.m")).cast("long").alias("form_n"))


def roots(rows: DataFrame) -> DataFrame:
    """Add root: where a word's forms end.  Forms grow in frequency, so they never
    lead back; each round doubles the way that a word has followed."""
    now = stored(rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        drop(now)
        now = step
        if now.filter("moved").isEmpty():
            break
    return rows.join(now.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word of the documents: its near words, its form and its root."""
    words = stored(vocabulary(table(spark, sf_dir, "documents")))
    return roots(stored(forms(words))).select("word", "form", "root", "n", "n_near", "form_n")


_LOW = f"translate(run, '{UPPER}', '{UPPER.lower()}')"
# Unsigned crc32 by the reflected polynomial 0xEDB88320 over a table of 256 entries, a byte at a time.
_CRC = """xor(4294967295::BIGINT, list_reduce(bytes, lambda a, b: xor(a >> 8, t[((xor(a, b)) & 255) + 1]), 4294967295::BIGINT))"""
ORACLE = f"""
WITH crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([0::BIGINT, 1, 2, 3, 4, 5, 6, 7], lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, i::BIGINT) AS c
    FROM range(256) r(i))),
found AS MATERIALIZED (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}')) AS run FROM documents),
low AS MATERIALIZED (SELECT coalesce(doc_id::VARCHAR, '') AS id, {_LOW} AS run, count(*) AS n FROM found GROUP BY ALL),
hexed AS (SELECT run, n, hex(encode(id || ':' || run)) AS x FROM low),
coded AS (SELECT run, n, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) AS bytes FROM hexed),
hashed AS MATERIALIZED (SELECT run, n, {_CRC} AS h FROM coded, crc_table),
slipped AS (SELECT CASE WHEN h % {SLIP} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
cut AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, LATERAL (SELECT unnest(range(length(word))) AS i)),
near AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS MATERIALIZED (SELECT word, any_value(n) AS n, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word),
pick AS MATERIALIZED (SELECT b.word, b.n, b.n_near, b.top, min(encode(e.other)) AS other FROM best b JOIN near e ON e.word = b.word AND e.other_n = b.top GROUP BY ALL),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(p.n_near, 0) AS n_near, CASE WHEN p.top >= {RATIO} * w.n THEN decode(p.other) END AS form,
         CASE WHEN p.top >= {RATIO} * w.n THEN p.top END AS form_n
  FROM words w LEFT JOIN pick p ON p.word = w.word),
chain AS (
  WITH RECURSIVE c(word, tip) AS (
    SELECT word, word FROM forms UNION ALL SELECT c.word, f.form FROM c JOIN forms f ON f.word = c.tip WHERE f.form IS NOT NULL)
  SELECT c.word, c.tip AS root FROM c JOIN forms f ON f.word = c.tip WHERE f.form IS NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM forms f JOIN chain c ON c.word = f.word
"""
