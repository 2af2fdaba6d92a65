"""N-gram Jaccard join by signature trees, with exact connected components.

Documents are sets of distinct word shingles; two of them link when their
Jaccard similarity is at least ``NUM / DEN``.  The result is exact: no cap, no
approximate candidate search.

1. Equal sets are one class; a class is searched once, whatever its copies.
2. Classes meet at members of a prefix of their sets in a common order.  With
   a = ceil(t * n) and l = ceil(a / EIGHTH), two sets that link share at least l
   of the first n - a + l members of either (prefix filter, l of the larger set
   being the larger): a class with fewer than l members that any other class has
   in its prefix can't link and ends here.  The order puts members found in many documents last: a fixed-size
   bitmap marks them (any order gives the same result; this one keeps shared
   passages from bringing unlike documents together).
3. Signature trees join what meets: the leaves are sets with token bitmaps, a
   node holds the OR of the bitmaps below and their range of sizes, and a dual
   traversal drops node pairs whose greatest possible overlap can't reach the
   threshold, or all of whose sets are known to be connected already.  What
   remains at the leaves is verified on the sets themselves.
   a. Each class goes to one meeting point only, in bounded blocks; this
      collapses groups of near copies, however large, into one label.
   b. Then all classes that meet but have different labels are compared: pairs
      of labels, the smaller one sent to the blocks of the larger; meeting
      points with very many labels as a grid of their blocks.
4. Links make components by distributed star rounds.

Class ids are 64-bit hashes of the set (at a thousand million different sets,
two of them coincide with a chance of 3 %).

Edge cases: null, empty and blank texts have an empty set, link with nothing
and are their own component; fewer words than ``N`` make one shingle; rows with
equal ids count one by one and share their component only if their sets link;
null ids never name a component that has another id; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopline.llm.common import by_stream, drop, stored, table
from shopline.llm.components import components

N, NUM, DEN = 5, 75, 100
#: Bits of a signature, and of the bitmap of members found in many documents.
BITS, COMMON_BITS = 2048, 1 << 26
#: The part of the least overlap that must be found within the prefixes.
EIGHTH = 8
#: A block of a join holds about so many sets, and so many members in all.
BLOCK, BLOCK_MEMBERS = 1024, 1_500_000
#: Meeting points with more labels than this are joined block by block.
MANY_LABELS = 64
LEAF = 16


# --- sets ---------------------------------------------------------------------------

_ODD = 0x9E3779B97F4A7C15
_UNDO = pow(_ODD, -1, 1 << 64)
_BYTE = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
#: Bytes whose words are hashed at a time.
STRETCH = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)]).cumprod(dtype=np.uint64) for x in (_ODD, _UNDO))


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word's bytes: a polynomial in their position, from running sums."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(end, start[at] + STRETCH, side="right")))
        lo, hi = int(start[at]), int(end[upto - 1])
        up, down = _powers(STRETCH) if hi - lo <= STRETCH else _powers.__wrapped__(hi - lo)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data[lo:hi]] * up[:hi - lo], dtype=np.uint64)])
        a, b = start[at:upto] - lo, end[at:upto] - lo
        out[at:upto] = _mixed((total[b] - total[a]) * down[a])
        at = upto
    return out


def shingle_sets(texts: pa.Array, n: int = N) -> tuple[list[np.ndarray], np.ndarray]:
    """For a binary column: each text's sorted distinct shingle hashes, and the class of each set."""
    texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    solid = _SOLID[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    before = np.concatenate([[False], solid[:-1]])[:len(data)]
    after = np.concatenate([solid[1:], [False]])[:len(data)]
    start = np.flatnonzero(solid & (~before | border[:-1]))
    end = np.flatnonzero(solid & (~after | border[1:])) + 1
    words = _word_hashes(data, start, end)
    grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        grams += words[k:len(grams) + k] * np.uint64(pow(_ODD, k + 1, 1 << 64))
    grams = _mixed(grams).view(np.int64)
    span = np.searchsorted(start, offsets).tolist()
    sets, cls = [], np.zeros(len(texts), np.uint64)
    for i, (lo, hi) in enumerate(zip(span, span[1:], strict=False)):
        if hi - lo >= n:
            own = np.unique(grams[lo:hi - n + 1])
        elif hi > lo:
            own = _mixed((words[lo:hi] * np.array([pow(_ODD, k + 9, 1 << 64) for k in range(hi - lo)], np.uint64)).sum(dtype=np.uint64, keepdims=True)).view(np.int64)
        else:
            own = grams[:0]
        sets.append(own)
        cls[i] = _mixed(own.view(np.uint64) ^ np.uint64(_UNDO)).sum(dtype=np.uint64) + np.uint64(len(own))
    return sets, _mixed(cls).view(np.int64)


def _binary(text: str) -> Column:
    return F.col(text).cast("binary")


# --- the order of members -------------------------------------------------------

def scan(docs: DataFrame, doc_id: str, text: str, held: int = 4_000_000) -> DataFrame:
    """One pass over all texts.  Rows with doc_id, n and cls are the documents;
    rows with member and times are members that a task found in three or more
    of the sets that it held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        parts, size = [], 0

        def often() -> dict:
            member, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.int64),) * 2
            member, n = member[n >= 3], n[n >= 3]
            empty = [None] * len(member)
            return {"doc_id": empty, "n": empty, "cls": empty, "member": member, "times": n}

        for batch in batches:
            sets, cls = shingle_sets(batch.column(1))
            empty = [None] * len(sets)
            yield {"doc_id": batch.column(0), "n": [len(s) for s in sets], "cls": cls, "member": empty, "times": empty}
            parts += sets
            size += sum(map(len, sets))
            if size > held:
                yield often()
                parts, size = [], 0
        yield often()

    return by_stream(docs, [F.col(doc_id).cast("long"), _binary(text)], "doc_id long, n long, cls long, member long, times long", run)


def common_members(scanned: DataFrame, least: int) -> bytes:
    """Bitmap of members that occur often: those whose counts add up to
    ``least``.  Whatever this misses or marks too much changes only the order of
    members, not the result."""
    hot = scanned.filter("member is not null").groupBy("member").agg(F.sum("times").alias("times")).filter(F.col("times") >= least)
    return bitmap(hot.select("member"))


def bitmap(hashes: DataFrame) -> bytes:
    """COMMON_BITS bits, one for each remainder of the hashes in the first column:
    a fixed size, whatever their number.  Tasks send their marked stretches."""
    chunk = 1 << 15

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy() & (COMMON_BITS - 1)
            for c in np.unique(at // chunk).tolist():
                own = bits.setdefault(c, np.zeros(chunk, bool))
                own[at[at // chunk == c] % chunk] = True
        yield {"chunk": list(bits), "bits": [np.packbits(b).tobytes() for b in bits.values()]}

    marked = by_stream(hashes, [F.col(hashes.columns[0])], "chunk long, bits binary", mark)
    whole = np.zeros(COMMON_BITS // 8, np.uint8)
    for row in marked.toLocalIterator():
        at = row.chunk * chunk // 8
        whole[at:at + chunk // 8] |= np.frombuffer(row.bits, np.uint8)
    return whole.tobytes()


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & (COMMON_BITS - 1)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _overlap(n: int) -> int:
    """What a set of n members shares at least with any that it links with."""
    return -(-NUM * n // DEN)


def _shared(overlap: int) -> int:
    """How many of those are in both prefixes at least."""
    return -(-overlap // EIGHTH)


def _least_shared(n: Column) -> Column:
    return F.ceil(F.ceil(n * NUM / F.lit(float(DEN))) / float(EIGHTH))


def prefixes(docs: DataFrame, text: str, common: bytes) -> DataFrame:
    """(member, cls, n): the members at which a class may meet those it links with."""
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bits = np.frombuffer(sent.value, np.uint8)
        seen: set[int] = set()
        for batch in batches:
            member, cls, size = [], [], []
            for own, c in zip(*shingle_sets(batch.column(0)), strict=True):
                c, n = int(c), len(own)
                if not n or c in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(c)
                late = _marked(bits, own)
                need = n - _overlap(n) + _shared(_overlap(n))
                first = own[~late]
                member.append(first[:need] if len(first) >= need else np.concatenate([first, own[late][:need - len(first)]]))
                cls.append(c)
                size.append(n)
            times = [len(m) for m in member]
            yield {"member": np.concatenate(member) if member else np.zeros(0, np.int64),
                   "cls": np.repeat(np.array(cls, np.int64), times), "n": np.repeat(np.array(size, np.int64), times)}

    return by_stream(docs, [_binary(text)], "member long, cls long, n long", cut)


def sets_of(docs: DataFrame, text: str, wanted: bytes) -> DataFrame:
    """(cls, set) of the classes that a bitmap marks (and of a few others); a
    class may come from several tasks, once from each."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bits, seen = np.frombuffer(sent.value, np.uint8), set()
        for batch in batches:
            sets, cls = shingle_sets(batch.column(0))
            keep = []
            for i in np.flatnonzero(_marked(bits, cls)).tolist():
                if cls[i] not in seen and len(sets[i]):
                    seen.add(cls[i])
                    keep.append(i)
            own = [sets[i] for i in keep]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in own])]).astype(np.int32)
            flat = np.concatenate(own) if own else np.zeros(0, np.int64)
            yield {"cls": cls[keep] if keep else [], "set": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))}

    return by_stream(docs, [_binary(text)], "cls long, set array<long>", run)


def with_class(df: DataFrame, text: str, name: str = "__cls_of") -> DataFrame:
    """Add the class of a text's set."""
    keep = df.columns
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"`{name}` long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {c: batch.column(i) for i, c in enumerate(keep)} | {name: shingle_sets(batch.column(len(keep)))[1]}

    return by_stream(df, [F.col(f"`{c}`") for c in keep] + [_binary(f"`{text}`").alias("__binary")], schema, run)


# --- signature trees -------------------------------------------------------------

class Tree:
    """Signature tree over sets in the order of their size."""

    def __init__(self, ids: np.ndarray, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][0] if len(sets[i]) else 0))
        self.ids, self.sets = ids[order], [sets[i] for i in order]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        flags = np.zeros((len(sets), BITS), bool)
        for i, s in enumerate(self.sets):
            flags[i, s & (BITS - 1)] = True
        self.bits = np.packbits(flags, axis=1).view(np.uint64)
        # Members that share a bit with another member of their set.
        self.surplus = self.sizes - np.bitwise_count(self.bits).sum(1).astype(np.int64)
        self.nodes: list[tuple] = []  # (from, to, bits, least size, greatest size, greatest surplus, children)
        self.root = self._build(0, len(sets))

    def _build(self, lo: int, hi: int) -> int:
        if hi - lo <= LEAF:
            kids = None
            bits = np.bitwise_or.reduce(self.bits[lo:hi], axis=0)
            surplus = int(self.surplus[lo:hi].max())
        else:
            mid = (lo + hi) // 2
            kids = self._build(lo, mid), self._build(mid, hi)
            left, right = self.nodes[kids[0]], self.nodes[kids[1]]
            bits, surplus = left[2] | right[2], max(left[5], right[5])
        self.nodes.append((lo, hi, bits, int(self.sizes[lo]), int(self.sizes[hi - 1]), surplus, kids))
        return len(self.nodes) - 1


class Join:
    """Dual traversal of one tree with itself, or of two; collects links that connect labels."""

    def __init__(self, left: Tree, right: Tree | None, label_of: dict[int, int]):
        self.left, self.right = left, right or left
        self.links: list[tuple[int, int]] = []
        known: dict[int, int] = {}
        name = lambda t: np.array([known.setdefault(label_of[i], len(known)) for i in t.ids.tolist()], np.int64)
        self.mine = name(left)
        self.other = name(self.right) if right else self.mine
        if len(left.sets) and len(self.right.sets):
            if right is None:
                self._within(left.root)
            else:
                self._across(left.root, right.root)

    def _connect(self, a: int, b: int) -> None:
        old, new = self.other[b], self.mine[a]
        self.mine[self.mine == old] = new
        if self.other is not self.mine:
            self.other[self.other == old] = new

    def _within(self, node: int) -> None:
        kids = self.left.nodes[node][6]
        if kids:
            self._within(kids[0])
            self._within(kids[1])
            self._across(*kids)
        else:
            self._leaves(node, node)

    def _across(self, start_a: int, start_b: int) -> None:
        todo = [(start_a, start_b)]
        while todo:
            a, b = todo.pop()
            lo, hi, bits, least, most, surplus, kids = self.left.nodes[a]
            lo2, hi2, bits2, least2, most2, surplus2, kids2 = self.right.nodes[b]
            if most * DEN < NUM * least2 or most2 * DEN < NUM * least:
                continue
            overlap = int(np.bitwise_count(bits & bits2).sum()) + min(surplus, surplus2)
            # intersection * DEN >= NUM * union is intersection * (DEN + NUM) >= NUM * (sum of sizes)
            if overlap * (DEN + NUM) < NUM * (least + least2):
                continue
            one = self.mine[lo]
            if (self.mine[lo:hi] == one).all() and (self.other[lo2:hi2] == one).all():
                continue
            if not kids and not kids2:
                self._leaves(a, b)
            elif not kids2 or (kids and hi - lo >= hi2 - lo2):
                todo += [(kids[1], b), (kids[0], b)]
            else:
                todo += [(a, kids2[1]), (a, kids2[0])]

    def _leaves(self, a: int, b: int) -> None:
        t, u = self.left, self.right
        lo, hi = t.nodes[a][:2]
        lo2, hi2 = u.nodes[b][:2]
        both = np.bitwise_count(t.bits[lo:hi, None, :] & u.bits[None, lo2:hi2, :]).sum(2).astype(np.int64)
        both += np.minimum(t.surplus[lo:hi, None], u.surplus[None, lo2:hi2])
        both = np.minimum(both, np.minimum(t.sizes[lo:hi, None], u.sizes[None, lo2:hi2]))
        may = both * (DEN + NUM) >= NUM * (t.sizes[lo:hi, None] + u.sizes[None, lo2:hi2])
        if t is u and a == b:
            may = np.triu(may, 1)
        for i, j in zip(*(x.tolist() for x in np.nonzero(may)), strict=True):
            if self.mine[lo + i] != self.other[lo2 + j] and linked(t.sets[lo + i], u.sets[lo2 + j]):
                self.links.append((int(t.ids[lo + i]), int(u.ids[lo2 + j])))
                self._connect(lo + i, lo2 + j)


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Exact test of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    shared = int((y[at] == x).sum())
    return shared * (DEN + NUM) >= NUM * (len(x) + len(y))


def join_groups(rows: DataFrame) -> DataFrame:
    """Links (a, b) of each group of rows (key, side, cls, label, set).

    A group is one bounded block, or two (sides 0 and 1) to be compared with
    each other; the groups of a task are read one after another.
    """
    rows = rows.repartition("key").sortWithinPartitions("key")

    def found(keyed: dict) -> list[tuple[int, int]]:
        (ids, sets, labels), (ids2, sets2, labels2) = keyed[0], keyed[1]
        if not ids:
            return []
        label_of = dict(zip(ids + ids2, labels + labels2, strict=True))
        return Join(_unique(ids, sets), _unique(ids2, sets2) if ids2 else None, label_of).links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, keyed = None, {0: ([], [], []), 1: ([], [], [])}
        for batch in batches:
            sets_here = batch.column(4)
            offsets, values = sets_here.offsets.to_pylist(), sets_here.values.to_numpy(zero_copy_only=False)
            out: list[tuple[int, int]] = []
            for r, (key, side, cls, label) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)):
                if key != now:
                    if now is not None:
                        out += found(keyed)
                    now, keyed = key, {0: ([], [], []), 1: ([], [], [])}
                ids, sets, labels = keyed[side]
                ids.append(cls)
                sets.append(values[offsets[r]:offsets[r + 1]].copy())
                labels.append(label)
            yield {"a": [x for x, _ in out], "b": [x for _, x in out]}
        out = found(keyed) if now is not None else []
        yield {"a": [x for x, _ in out], "b": [x for _, x in out]}

    return by_stream(rows, [F.col(c) for c in ("key", "side", "cls", "label", "set")], "a long, b long", run)


def _unique(ids: list[int], sets: list[np.ndarray]) -> Tree:
    own = dict(zip(ids, sets, strict=True))
    return Tree(np.array(list(own), np.int64), list(own.values()))


# --- the join ----------------------------------------------------------------------

def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Add label: the class's component so far (itself, if none)."""
    if labels is None:
        return rows.withColumn("label", F.col("cls"))
    own = labels.select(F.col("id").alias("cls"), F.col("component").alias("label"))
    return rows.join(own, "cls", "left").withColumn("label", F.coalesce("label", "cls"))


def _active(meet: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows of the meeting points where more than one label meets, with the label."""
    rows = _labelled(meet, labels)
    mixed = rows.groupBy("member").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("member")
    return rows.join(mixed, "member")


def _blocks(n: Column, members: Column) -> Column:
    return F.greatest(F.ceil(n / BLOCK), F.ceil(members / BLOCK_MEMBERS)).cast("int")


def _collapse(active: DataFrame, sets: DataFrame) -> DataFrame:
    """Links found when each class goes to one of its meeting points."""
    one = active.groupBy("cls", "label", "n").agg(F.min_by("member", F.xxhash64("member")).alias("member"))
    one = stored(one)
    size = one.groupBy("member").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).filter("c > 1")
    one = one.join(size, "member").withColumn("block", F.pmod(F.xxhash64("cls", "member"), _blocks(F.col("c"), F.col("s"))))
    keyed = one.select(F.struct("member", "block").alias("k"), "cls", "label")
    return join_groups(_with_sets(keyed.withColumn("side", F.lit(0)), sets))


def _with_sets(keyed: DataFrame, sets: DataFrame) -> DataFrame:
    return keyed.join(sets.select("cls", "set"), "cls").select(F.xxhash64("k").alias("key"), "side", "cls", "label", "set")


def _rest(active: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between all classes that meet and have different labels."""
    active = stored(active)
    by_label = active.groupBy("member", "label").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    count = by_label.groupBy("member").agg(F.count(F.lit(1)).alias("labels"))
    few = by_label.join(count.filter(F.col("labels") <= MANY_LABELS).select("member"), "member")
    a, b = few.alias("a"), few.alias("b")
    fits = (F.col("a.most") * DEN >= NUM * F.col("b.least")) & (F.col("b.most") * DEN >= NUM * F.col("a.least"))
    pairs = a.join(b, F.col("a.member") == F.col("b.member")).filter((F.col("a.label") < F.col("b.label")) & fits)
    pairs = pairs.select(F.col("a.label").alias("x"), F.col("b.label").alias("y")).distinct()
    classes = stored(active.select("cls", "label", "n").distinct())
    size = classes.groupBy("label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    sized = (pairs.join(size.select(F.col("label").alias("x"), F.col("c").alias("cx"), F.col("s").alias("sx")), "x")
             .join(size.select(F.col("label").alias("y"), F.col("c").alias("cy"), F.col("s").alias("sy")), "y"))
    bigger = (F.col("cx") > F.col("cy")) | ((F.col("cx") == F.col("cy")) & (F.col("x") < F.col("y")))
    pick = lambda p, q: F.when(bigger, F.col(p)).otherwise(F.col(q))
    sized = stored(sized.select(pick("x", "y").alias("big"), pick("y", "x").alias("small"), pick("cx", "cy").alias("cb"), pick("sx", "sy").alias("sb"),
                                pick("cy", "cx").alias("cs"), pick("sy", "sx").alias("ss")))
    grid = sized.groupBy("big").agg(F.max("cb").alias("cb"), F.max("sb").alias("sb"), F.sum("cs").alias("cs"), F.sum("ss").alias("ss"))
    grid = grid.select("big", _blocks(F.col("cb"), F.col("sb")).alias("rows"), _blocks(F.col("cs"), F.col("ss")).alias("cols"))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    large = (classes.join(grid, classes.label == grid.big).withColumn("i", F.pmod(F.xxhash64("cls"), "rows").cast("int"))
             .withColumn("j", F.explode(upto("cols"))).withColumn("side", F.lit(0)))
    small = (classes.join(sized.select("big", "small"), classes.label == F.col("small")).join(grid, "big")
             .withColumn("j", F.pmod(F.xxhash64("cls"), "cols").cast("int")).withColumn("i", F.explode(upto("rows"))).withColumn("side", F.lit(1)))
    cols = [F.struct(F.lit(0).alias("kind"), F.col("big"), F.col("i"), F.col("j")).alias("k"), F.col("cls"), F.col("label"), F.col("side")]
    links = join_groups(_with_sets(large.select(*cols).unionByName(small.select(*cols)), sets))
    # Meeting points of very many labels: every block with itself and with each later one.
    many = active.join(count.filter(F.col("labels") > MANY_LABELS).select("member"), "member")
    wide = many.groupBy("member").agg(_blocks(F.count(F.lit(1)), F.sum("n")).alias("rows"))
    many = many.join(wide, "member").withColumn("i", F.pmod(F.xxhash64("cls"), "rows").cast("int"))
    many = many.withColumn("j", F.explode(upto("rows"))).withColumn("side", (F.col("j") < F.col("i")).cast("int"))
    key = F.struct(F.lit(1).alias("kind"), F.col("member").alias("big"), F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
    return links.unionByName(join_groups(_with_sets(many.select(key.alias("k"), "cls", "label", "side"), sets)))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, cls, component) per row of ``docs``;
    cls is the class of the row's set, component the smallest class linked with
    it (null for an empty set)."""
    scanned = stored(scan(docs, doc_id, text))
    rows_of = scanned.filter("cls is not null").select("doc_id", "n", "cls")
    documents = rows_of.count()
    # At most set size x 100,000 members are in one of 100,000 documents: what the bitmap has room for.
    common = common_members(scanned, max(8, documents // 100_000))
    meet = prefixes(docs, text, common)
    here = Window.partitionBy("member")
    meet = meet.withColumns({"lo": F.min("cls").over(here), "hi": F.max("cls").over(here)}).filter("lo != hi")
    meet = stored(meet.select("member", "cls", "n").distinct())
    able = meet.groupBy("cls", "n").agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= _least_shared(F.col("n")))
    able = stored(able.select("cls"))
    before, meet = meet, stored(meet.join(able, "cls"))
    drop(before)
    sets = stored(sets_of(docs, text, bitmap(able)))
    # Once: a second round moves all sets again, and most that are left don't link.
    links = stored(_collapse(_active(meet, None), sets))
    labels = stored(components(links))
    links = links.unionByName(stored(_rest(_active(meet, labels), sets)))
    comps = components(links).select(F.col("id").alias("cls"), "component")
    placed = rows_of.join(comps, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    # An empty set is a component of its own row; copies of a class are one component.
    placed = placed.withColumn("component", F.when(F.col("n") > 0, F.col("component")))
    first = placed.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = placed.join(first, "component", "left")
    smallest = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), smallest.alias("component_id"), "cls", "component")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component, one row
    with its smallest id (of several such rows, the first by class and text).
    An empty text is a component with the rows of its own id only."""
    found = near_duplicates(docs, doc_id, text)
    named = F.struct(F.col("doc_id").isNull(), "doc_id", "cls")  # null ids last
    single = F.when(F.col("component").isNull(), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    chosen = found.groupBy("component", single.alias("single")).agg(F.min(named).alias("r"))
    chosen = stored(chosen.select(F.col("r.doc_id").alias("__id"), F.col("r.cls").alias("__cls")))
    rows = with_class(docs.join(chosen, docs[doc_id].eqNullSafe(chosen["__id"])), text).filter("__cls_of = __cls")
    first = Window.partitionBy(doc_id, "__cls").orderBy(text)
    return rows.withColumn("__row", F.row_number().over(first)).filter("`__row` = 1").select(*docs.columns)


def op7_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and near-duplicate component."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
