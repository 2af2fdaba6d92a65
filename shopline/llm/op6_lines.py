"""Fuzzy line deduplication by MinHash, in DataFrame operations only.

A line's set are its character shingles: the ``SHINGLE`` characters from each
character on, a run of blanks counted as one and none at the ends (a shorter
line is one shingle).  Lines whose sets have a Jaccard similarity of at least ``threshold`` are linked, and of each connected
component of links, one line stays: the first by (document id, position).
Equal lines are one line from the beginning, however short.  Lines of fewer than
``min_chars`` characters besides blanks are always kept (by default only those with none).

1. The scan takes each line's id, a 128-bit hash, and its ``BANDS`` band keys of ``ROWS`` minima each; ids
   with their bands go through one shuffle, the texts don't.  Minima are one-permutation
   minima: the first hashes from each of ``BANDS`` boundaries on.  They are taken over
   a sample of the shingles that each shingle decides by its own first character
   (``STARTS``), or over all of them for lines with few of those; lines in between have
   bands of both kinds.
2. Lines that share a band form a bucket.  Every member of a similar size is compared to the
   bucket's smallest line id by exact Jaccard similarity of the whole sets.  Buckets whose
   members are not all connected then go on, linked members too.  Those of more than
   GROWTH members are replaced by buckets of their lines' rarest shingles, which
   lose no link (prefix and position filter): a passage or a text that many lines
   share brings no unlike lines together there.  In each round
   the next members in the order of the line ids, GROWTH times as many as
   before, are compared to all later ones that are not connected with them
   yet, until all members of a bucket are connected or compared.  Buckets have
   no cap; only unlike lines that share a rare shingle cost their square.
3. Links make components by distributed star rounds.
4. Occurrences other than a component's first are dropped.

Edge cases: null texts and blank lines have nothing to drop (a null text stays
null); a document whose words are all gone keeps an empty text and has
``n_kept_lines`` 0; rows with equal id and text count as one document; ties
can't occur between different occurrences; very long lines are treated as any
other; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopline.llm.common import BLANKS, drop, stored, table
from shopline.llm.components import components

SHINGLE = 12
ROWS, BANDS, GROWTH = 4, 14, 16
THRESHOLD = 0.8
MIN_CHARS = 1
#: Shingles that begin with one of these make the bands: every seventh character of Latin-1, all others of Unicode.
STARTS = "".join(f"\\x{i:02x}" for i in range(0, 256, 7))
OTHERS = "[^\\x00-\\xff]"
#: Lines with fewer such shingles than the first have bands of all their shingles; than the second, of both.
FEW, FEWER_THAN = 10, 16
#: A bitmap of line ids has about so many bits for each, within bounds (16 MB at most).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27
ID = ["h1", "h2"]


def _line_id(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def _row_key(doc_id: str, text: str) -> Column:
    """Rows with equal id and text share it."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def occurrences(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """One row per line that takes part: its id h1, h2, its text and its place (doc, row_key, at)."""
    rows = docs.select(F.col(doc_id).alias("doc"), _row_key(doc_id, text).alias("row_key"),
                       F.posexplode(F.split(F.col(text), "\n")).alias("at", "line"))
    own = F.col("line").rlike(f"[^{BLANKS}]")
    if min_chars > 1:
        own &= F.length(F.translate("line", BLANKS, "")) >= min_chars
    return rows.filter(own).select(*_line_id(F.col("line")), "line", "doc", "row_key", "at")


def _spaced(line: Column) -> Column:
    """The line without blanks at its ends, and runs of them as one."""
    odd = F.contains(line, F.lit("  "))
    for c in BLANKS.replace(" ", "").replace("\n", ""):
        odd |= F.contains(line, F.lit(c))
    return F.trim(F.when(odd, F.regexp_replace(line, f"[{BLANKS}]+", " ")).otherwise(line))


def _parts(spaced: Column, size: int) -> Column:
    """All shingles of a line."""
    # One pass: each match takes one character and captures ``size`` from it on.
    parts = F.regexp_extract_all(spaced, F.lit(f"(?s)(?=(.{{{size}}}))."), F.lit(1))
    return F.when(F.length(spaced) < size, F.array(spaced)).otherwise(parts)


def _hashes(parts: Column) -> Column:
    return F.transform(parts, lambda x: F.xxhash64(x))


def shingles(line: Column, size: int = SHINGLE) -> Column:
    """Distinct hashes of the character shingles of a line."""
    return F.array_distinct(_hashes(_parts(_spaced(line), size)))


def with_bands(lines: DataFrame) -> DataFrame:
    """Add ``bands``: a key per band of each line, the hash of ROWS minima.

    The minima of a band are the first ROWS hashes from its boundary on, around
    the end: two sets agree in each with the probability of their similarity.
    Sorting the boundaries in among the hashes tells how many lie below each, so
    all minima come from two sorted arrays.  Each step is a projection of its own,
    which keeps its result from being computed once a minimum.
    """
    limits = [-(1 << 63) + i * ((1 << 64) // BANDS) for i in range(BANDS)]
    # What follows the last shingle of the sample is taken as one match, an empty one: else each of its characters would be tried up to the end.
    found = lambda c: F.regexp_extract_all("__line", F.lit(f"(?s)[^{c}]*+(?:(?=([{c}].{{{SHINGLE - 1}}})).|.*+)"), F.lit(1))
    sample = lambda c: F.array_remove(found(c), "")
    # The plain class is the faster one.
    starts = F.when(F.col("__line").rlike(OTHERS), sample(STARTS + OTHERS)).otherwise(sample(STARTS))
    rows = lines.withColumn("__line", _spaced(F.col("line"))).withColumn("__0", starts)
    rows = rows.withColumn("__1", F.when(F.size("__0") < FEWER_THAN, _parts(F.col("__line"), SHINGLE)).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumns({c: _hashes(F.col(c)) for c in ("__0", "__1")})
    rows = rows.withColumns({f"{c}o": F.sort_array(c) for c in ("__0", "__1")} | {
        f"{c}s": F.sort_array(F.concat(c, F.array(*[F.lit(x).cast("long") for x in limits]))) for c in ("__0", "__1")})

    below = lambda c: F.array(*[F.array_position(f"{c}s", F.lit(x).cast("long")) - 1 - b for b, x in enumerate(limits)])
    # The first ones once more at the end.
    around = lambda c: F.when(F.size(c) < ROWS, F.flatten(F.array_repeat(c, ROWS + 1))).otherwise(F.concat(F.col(c), F.slice(c, 1, ROWS)))
    rows = rows.withColumns({f"{c}p": below(c) for c in ("__0", "__1")} | {f"{c}w": around(f"{c}o") for c in ("__0", "__1")})

    def keys(c: str, kind: int) -> Column:
        # A lambda is kept out of whole-stage code: all minima in one generated method would be too long for the JIT compiler.
        return F.transform(f"{c}p", lambda at, b: F.xxhash64(b + kind * BANDS, *[F.get(F.col(f"{c}w"), (at + r).cast("int")) for r in range(ROWS)]))

    none = F.array().cast("array<long>")
    made = F.concat(F.when(F.size("__0") >= FEW, keys("__0", 0)).otherwise(none), F.when(F.size("__1") >= 1, keys("__1", 1)).otherwise(none))
    return rows.withColumn("bands", made).drop("__line", *[f"__{k}{x}" for k in (0, 1) for x in ("", "o", "s", "p", "w")])


def distinct_lines(spots: DataFrame) -> DataFrame:
    """(h1, h2, first, last, bands) of each distinct line: its first and last place."""
    place = F.struct("doc", "row_key", "at")
    return with_bands(spots).groupBy(*ID).agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("bands").alias("bands"))


def _marked(ids: DataFrame, name: str) -> Column:
    """A test that is true for every hash of column ``name`` in ``ids`` and for few others: a bitmap that the scan looks into."""
    size = ids.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * size).bit_length()))
    bit = F.col(name).bitwiseAND(F.lit(bits - 1))
    own = F.expr(f"shiftleft(1L, cast({name} & 63 as int))")
    words = ids.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(own).alias("bits"))
    every = ids.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    # bits / 64 rows at most, whatever the number of ids.
    bitmap = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")))), lambda x: x["bits"]).alias("a"))
    word = F.get(bitmap.scalar(), F.shiftright(bit, 6).cast("int"))
    return word.bitwiseAND(own) != 0


def _compared(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The distinct pairs (id, r) that are similar enough, as links (a, b).

    The lines travel, not their sets, which are many times as large.
    """
    pairs = pairs.select("id", "r").distinct().join(texts, "id")
    both = pairs.join(texts.toDF("r", "other", "other_size"), "r")
    both = both.withColumns({c: _hashes(_parts(_spaced(F.col(c)), SHINGLE)) for c in ("line", "other")})
    # array_intersect takes each common hash once; the sizes are those of the sets.
    both = both.withColumn("common", F.size(F.array_intersect("line", "other")))
    similar = F.transform(F.array("common"), lambda c: c / (F.col("size") + F.col("other_size") - c) >= threshold)[0]
    # Stored before it is filtered: a filter would be pushed below, and make the sets once more.
    return stored(both.select(F.col("id").alias("a"), F.col("r").alias("b"), similar.alias("similar"))).filter("similar").drop("similar")


def _relabelled(members: DataFrame, good: DataFrame) -> DataFrame:
    """Members with the labels that the new links lead to."""
    label = members.select("id", "label").distinct()
    ends = good.join(label.toDF("a", "x"), "a").join(label.toDF("b", "y"), "b")
    moved = components(ends.select("x", "y"), "x", "y").toDF("label", "to")
    return members.join(moved, "label", "left").withColumn("label", F.coalesce("to", "label")).drop("to")


def _alike(size: str, other: str, threshold: float) -> Column:
    """A link needs sets of similar sizes."""
    return F.least(size, other) >= threshold * F.greatest(size, other)


def _by_rare_shingles(lines: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(band, id, label, size, at, n): the lines (id, label, size) in buckets of shingles; of
    each line those at the front when all are put in order, rarest first.

    Of two lines that link, the first shingle in common lies in the front of both,
    with no fewer after it in either than they must have in common.  Shingles of one
    line only take their places at the front, but need no bucket.
    """
    parts = lines.join(texts.select("id", "line"), "id").select("id", "label", "size", F.explode(shingles(F.col("line"))).alias("band"))
    parts = stored(parts)
    times = parts.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = parts.join(times, "band").groupBy("id", "label", "size").agg(F.sort_array(F.collect_list(F.struct("n", "band"))).alias("parts"))
    alone = F.col("size") - F.size("parts")
    front = F.floor(F.col("size") * (1 - threshold) + 1e-6).cast("int") + 1 - alone
    own = own.filter(front > 0).select("id", "label", "size", alone.alias("alone"), F.posexplode(F.slice("parts", F.lit(1), front)).alias("at", "part"))
    return own.select(F.col("part.band").alias("band"), "id", "label", "size", (F.col("at") + F.col("alone")).alias("at"), F.col("part.n").alias("n"))


def links(spots: DataFrame, lines: DataFrame, threshold: float) -> DataFrame:
    """Verified links (a, b) between distinct lines, ids as structs of h1 and h2."""
    rows = lines.select(*ID, F.explode("bands").alias("band"))
    # Map-side combined, and joined back: no bucket needs to fit one task.
    shared = stored(rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # Bands of one line only, nearly all, end at the bitmap.
    members = rows.filter(_marked(shared.select("band"), "band")).join(shared, "band")
    members = stored(members.select("band", F.struct(*ID).alias("id"), "n"))
    drop(shared)
    own = stored(members.select("id.h1", "id.h2").distinct())
    # Lines that share no bucket end here, nearly all of them in the scan; the others are few enough to keep.
    texts = spots.select(*ID, "line").filter(_marked(own.select("h1"), "h1")).join(own, ID, "left_semi")
    texts = texts.groupBy(*ID).agg(F.first("line").alias("line"))
    texts = stored(texts.select(F.struct(*ID).alias("id"), "line", F.size(shingles(F.col("line"))).alias("size")))
    members = stored(members.join(texts.select("id", "size"), "id"))
    first = members.groupBy("band").agg(F.min(F.struct("id", "size")).alias("first"))
    members = members.join(first.select("band", F.col("first.id").alias("r"), F.col("first.size").alias("other_size")), "band")
    good = found = _compared(members.filter((F.col("id") != F.col("r")) & _alike("size", "other_size", threshold)), texts, threshold)
    members = _relabelled(members.withColumn("label", F.col("id")), good).filter("id != r")
    rest = _mixed(members.select("band", "id", "label", "size", F.lit(0).alias("at"), "n"))
    if rest.isEmpty():
        return found
    large = rest.filter(F.col("n") > GROWTH).select("id", "label", "size").distinct()
    members = rest.filter(F.col("n") <= GROWTH).unionByName(_by_rare_shingles(large, texts, threshold))
    # A line's place among its bucket's members, 0 to 1: ids are hashes, so about n * x members lie below x.
    place = F.col("id.h1").cast("double") / float(1 << 64) + 0.5
    members = members.withColumn("place", place)
    previous, many = rest, GROWTH
    while True:
        rest = _mixed(members)
        drop(previous)
        previous = rest
        if rest.isEmpty():
            return found
        upto = F.lit(float(many)) / F.col("n")
        chosen = rest.filter(F.col("place") < upto).select("band", F.col("id").alias("r"), F.col("label").alias("other"), F.col("size").alias("other_size"), F.col("at").alias("other_at"))
        pairs = rest.join(chosen, "band").filter((F.col("id") > F.col("r")) & (F.col("label") != F.col("other")) & _alike("size", "other_size", threshold))
        common = F.least(F.col("size") - F.col("at"), F.col("other_size") - F.col("other_at"))
        pairs = pairs.filter(common * (1 + threshold) + 1e-6 >= (F.col("size") + F.col("other_size")) * threshold)
        good = _compared(pairs, texts, threshold)
        found = found.unionByName(good)
        # What was chosen has met all others of its bucket.
        members = _relabelled(rest.filter(F.col("place") >= upto), good)
        many *= GROWTH


def _mixed(members: DataFrame) -> DataFrame:
    """The members of buckets with different labels: all others are connected."""
    mixed = members.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi")
    return stored(members.join(mixed.select("band"), "band", "left_semi"))


def redundant(docs: DataFrame, doc_id: str, text: str, threshold: float = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, row_key, removed): positions of the lines to drop, for documents that have any."""
    spots = occurrences(docs, doc_id, text, min_chars)
    every = stored(distinct_lines(spots))
    comps = stored(components(links(spots, every, threshold)))
    comps = comps.select("id.h1", "id.h2", F.col("component.h1").alias("c1"), F.col("component.h2").alias("c2"))
    lines = every.drop("bands").join(comps, ID, "left")
    of = [F.coalesce(F.col(c), F.col(h)).alias(c) for c, h in zip(["c1", "c2"], ID, strict=True)]
    lines = lines.filter(F.col("c1").isNotNull() | (F.col("first") != F.col("last"))).select(*ID, *of, "first")
    lines = stored(lines)
    kept = lines.groupBy("c1", "c2").agg(F.min("first").alias("kept"))
    lines = lines.join(kept, ["c1", "c2"]).select(*ID, "kept")
    place = F.struct("doc", "row_key", "at")
    drops = spots.drop("line").join(lines, ID).filter(place != F.col("kept"))
    return drops.groupBy("doc", "row_key").agg(F.sort_array(F.collect_set("at")).alias("removed"))


def mark_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
               min_chars: int = MIN_CHARS, keep: list[str] | None = None) -> DataFrame:
    """Keep the named columns and add removed: the positions (from 0) of the lines to drop."""
    gone = redundant(docs, doc_id, text, threshold, min_chars)
    gone = gone.select(F.col("doc").alias("__of"), F.col("row_key").alias("__row_key"), F.col("removed").alias("__gone"))
    keep = [c for c in (keep or docs.columns) if c != "removed"]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(doc_id).alias("__doc"), _row_key(doc_id, text).alias("__key"))
    rows = rows.join(gone, F.col("__doc").eqNullSafe(F.col("__of")) & (F.col("__key") == F.col("__row_key")), "left")
    none = F.array().cast("array<int>")
    return rows.withColumn("removed", F.coalesce("__gone", none)).select(*keep, "removed")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with their redundant lines taken out of the text, and
    n_kept_lines (lines with a word that remain)."""
    rows = mark_lines(docs, doc_id, text, threshold, min_chars)
    left = F.transform(F.array(F.col("removed")), lambda gone: F.filter(F.split(F.col(text), "\n"), lambda line, i: ~F.array_contains(gone, i)))
    rows = rows.withColumn("__left", F.when(F.size("removed") > 0, F.flatten(left)).otherwise(F.split(F.col(text), "\n")))
    worded = F.size(F.filter(F.coalesce("__left", F.array().cast("array<string>")), lambda x: F.translate(x, BLANKS, "") != ""))
    rows = rows.withColumn("n_kept_lines", worded)
    rows = rows.withColumn(text, F.when(F.size("removed") > 0, F.concat_ws("\n", "__left")).otherwise(F.col(text)))
    return rows.drop("__left", "removed")


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines with a word, and the positions of those that go."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    worded = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    docs = docs.withColumn("n_lines", F.size(worded).cast("long"))
    rows = mark_lines(docs, keep=["doc_id", "n_lines"])
    return rows.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")
