"""Merkle manifest of a data set: a digest per row, subtrees per group, one root.

A leaf is the digest of a row's columns.  The leaves of a group, in the order of
their key, are cut into runs of ``FANOUT``; the digest of a run's digests is its
parent, level by level, until one node is left, the group's subroot.  The
subroots, in the order of their group, make the root the same way.  A row's
proof are the siblings that it meets on its way up.

1. A range partitioning by group and key puts the narrow leaf rows in order;
   counts per partition and group (a row each) turn places within a partition
   into places within a group, so no group needs to fit one task.
2. Going up, a level is one window over blocks of whole runs.  ``lead`` by 1 to
   15 places, masked by the row's slot and its run's length, gives the later
   siblings; rows in slot 0 hash them to the parent.  A level is stored.
3. Going down, ``lag`` and ``lead`` give each node its siblings on both sides.
   First children carry the steps of their parent, from where the window hands
   them to the others of the run, so the wide steps are joined to one row in 16.

Edge cases: a null column is ``-``; a null group is a group of its own and the
first one; a null key comes first; rows with equal key are ordered by their
leaf, so repeated rows are leaves side by side and each has a proof; a text of
any length is hashed in the scan and never shuffled; an empty table gives an
empty result without a root; extra columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopline.llm.common import drop, lower_ascii, residue, stored, table

FANOUT = 16
#: Places of a window's partition: whole runs, few enough to stay in memory.
BLOCK = FANOUT * 64
BLOCK_OF = f"floor(pos / {BLOCK})"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
STEPS = "array<struct<left: string, right: string>>"
#: A record number within a partition lies in these bits of a monotonic id.
LOCAL_BITS = 33


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(columns: list[Column]) -> Column:
    """Digest of the columns, each as its UTF-8 byte count, ``:`` and value, or ``-`` if null."""
    texts = [c.cast("string") for c in columns]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def group_key(group: Column) -> Column:
    """Text that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def placed(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add pos (from 0) and n: a row's place in its group, and the group's rows."""
    by = [*group, *order]
    # Stored: bounds of ranges come from a sample, and another run could draw others.
    rows = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__id", F.monotonically_increasing_id()))
    rows = rows.withColumn("__part", F.shiftright("__id", LOCAL_BITS))
    of_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = of_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per partition and group; what is joined back has a partition's rows per key at most.
    marks = rows.groupBy("__part", *group).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    marks = marks.select("__part", *group, (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
                         F.sum("__rows").over(of_group).alias("n"))
    out = rows.join(marks, ["__part", *group]).withColumn("pos", F.col("__id") + F.col("__shift"))
    out = stored(out.drop("__id", "__part", "__shift"))
    drop(rows)
    return out


#: A node's place in its run.
SLOT = f"pos % {FANOUT}"


def _siblings(group: list[str]) -> tuple[Column, Column]:
    """Digests of the run's nodes before and after a node, joined."""
    w = f"OVER (PARTITION BY {', '.join([*group, BLOCK_OF])} ORDER BY pos)"
    run = f"least({FANOUT}, n - pos + {SLOT})"
    left = [f"CASE WHEN {SLOT} >= {k} THEN lag(node, {k}) {w} END" for k in range(FANOUT - 1, 0, -1)]
    right = [f"CASE WHEN {SLOT} + {k} < {run} THEN lead(node, {k}) {w} END" for k in range(1, FANOUT)]
    return F.expr(f"concat_ws('', {', '.join(left)})"), F.expr(f"concat_ws('', {', '.join(right)})")


def climb(leaves: DataFrame, group: list[str]) -> list[DataFrame]:
    """Levels of the groups' trees, each (group, pos, n, node), the leaves first.

    A group's topmost node is the one with n = 1; the group ends there.
    """
    levels, most = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        below = levels[-1].select(*group, "pos", "n", "node")
        with_later = below.filter("n > 1").withColumn("later", _siblings(group)[1])
        parents = with_later.filter(f"{SLOT} = 0").select(
            *group, F.floor(F.col("pos") / FANOUT).alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"),
            digest(F.col("node"), F.col("later")).alias("node"))
        levels.append(stored(parents))
        most = -(-most // FANOUT)
    return levels


def tops(levels: list[DataFrame], group: list[str]) -> DataFrame:
    """(group, node): the topmost node of each group's tree."""
    found = [level.filter("n = 1").select(*group, "node") for level in levels]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def descend(levels: list[DataFrame], group: list[str], above: DataFrame) -> DataFrame:
    """The leaves with ``up``: what ``above`` (group, up) says of their tree, its
    steps after the steps within the tree.  Levels above the leaves are stored,
    so that no plan holds more than one level's windows."""
    found = None
    for level in reversed(levels):
        if found is not None:
            found = stored(found)
        run = F.floor(F.col("pos") / FANOUT)
        first = level.filter("n = 1").join(above, group) if group else level.filter("n = 1").crossJoin(above)
        if found is not None:
            parents = found.select(*group, F.col("pos").alias("__run"), "up")
            first = first.unionByName(level.filter(f"n > 1 AND {SLOT} = 0").withColumn("__run", run)
                                      .join(parents, [*group, "__run"]).drop("__run"))
        others = level.filter(f"n > 1 AND {SLOT} != 0").withColumn("up", F.lit(None).cast(dict(first.dtypes)["up"]))
        left, right = _siblings(group)
        block = Window.partitionBy(*group, F.expr(BLOCK_OF)).orderBy("pos")
        of_first = F.last("up", ignorenulls=True).over(block.rowsBetween(Window.unboundedPreceding, 0))
        rows = first.unionByName(others).withColumns({"__left": left, "__right": right, "up": of_first})
        steps = F.concat(F.array(F.struct(F.col("__left").alias("left"), F.col("__right").alias("right"))), F.col("up.steps"))
        rows = rows.withColumn("up", F.when(F.col("n") > 1, F.col("up").withField("steps", steps)).otherwise(F.col("up")))
        found = rows.drop("__left", "__right")
    return found


def manifest(rows: DataFrame, key: str, group: str, leaves: dict[str, Column]) -> tuple[DataFrame, str | None, list[DataFrame]]:
    """Rows with their proofs, the root's digest and the stored levels of the groups' trees.

    ``leaves`` names digests to keep of each row; the one named ``leaf`` makes
    the tree.  The rows have key, group, those digests, ``subroot`` and
    ``steps``: per level the siblings before and after the row's node.
    """
    g, node = ["__group"], F.col("leaf").alias("node")
    narrow = rows.select(F.col(f"`{key}`").alias(key), F.col(f"`{group}`").alias(group), group_key(F.col(f"`{group}`")).alias("__group"),
                         *[c.alias(name) for name, c in leaves.items()])
    narrow = placed(stored(narrow), g, [key, "leaf"])
    levels = climb(narrow.select("*", node), g)
    subroots = placed(tops(levels, g), [], g)
    upper = climb(subroots, [])
    root = tops(upper, []).first()
    none = F.from_json(F.lit("[]"), STEPS)
    above = descend(upper, [], rows.sparkSession.range(1).select(F.struct(none.alias("steps")).alias("up")))
    above = stored(above.select("__group", F.struct(F.col("node").alias("subroot"), F.col("up.steps").alias("steps")).alias("up")))
    proved = descend(levels, g, above)
    out = proved.select(key, group, *leaves, F.col("up.subroot").alias("subroot"), F.col("up.steps").alias("steps"))
    return out, root[0] if root else None, levels


def proof(steps: str = "steps") -> Column:
    """All siblings of the steps, from the leaf to the root, left to right."""
    return F.concat_ws("", F.transform(F.col(steps), lambda s: F.concat(s["left"], s["right"])))


def folded(leaf: Column, steps: str = "steps") -> Column:
    """The root that a leaf and its steps lead to."""
    return F.aggregate(F.col(steps), leaf, lambda node, s: digest(s["left"], node, s["right"]))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its leaf, roots and proof, and what the proof says of the (partly tampered) row."""
    docs = table(spark, sf_dir, "documents")
    of = {c: F.col(c) for c in COLUMNS}
    tampered = F.when(residue(F.col("doc_id"), 5) == 0, leaf(list((of | {"text": lower_ascii(F.col("text"))}).values())))
    rows, root, _ = manifest(docs, "doc_id", "source", {"leaf": leaf(list(of.values())), "tampered": tampered})
    out = rows.select("doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), F.sha2(proof(), 256).alias("proof_sha256"),
                      folded(F.coalesce("tampered", "leaf")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(levels: int = 8) -> str:
    """The same in DuckDB: unrolled aggregation by run, for up to FANOUT ** levels rows a group."""
    # Unsigned crc32 of the decimal id by the reflected polynomial 0xEDB88320, bit by bit.
    bit = "CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"
    byte = f"list_reduce(range(9), lambda c, k: {bit}, xor(a, b))".replace("range(9)", "[0::BIGINT, 1, 2, 3, 4, 5, 6, 7]")
    crc = (f"xor(4294967295::BIGINT, list_reduce(list_transform(range(length(t)), lambda i: ascii(t[i + 1])::BIGINT), "
           f"lambda a, b: {byte}, 4294967295::BIGINT))")
    field = lambda x: f"coalesce(strlen(({x})::VARCHAR) || ':' || ({x})::VARCHAR, '-')"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hashed = lambda text: "sha256(" + " || ".join(field(c) for c in ["doc_id", "source", "lang", "n_chars", text]) + ")"
    low = f"translate(text, '{upper}', '{upper.lower()}')"
    ctes = [
        f"ids AS (SELECT DISTINCT doc_id, doc_id::VARCHAR AS t FROM documents WHERE doc_id IS NOT NULL)",
        f"crcs AS (SELECT doc_id, {crc} AS crc FROM ids)",
        f"leaves AS (SELECT d.doc_id, d.source, {hashed('d.text').replace('doc_id', 'd.doc_id').replace('d.d.', 'd.')} AS leaf, "
        f"CASE WHEN crc % 5 = 0 THEN {hashed(low).replace('doc_id', 'd.doc_id')} END AS tampered "
        f"FROM documents d LEFT JOIN crcs c ON c.doc_id = d.doc_id)",
        "n0 AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, "
        "count(*) OVER (PARTITION BY source) AS n, leaf AS node, doc_id, tampered FROM leaves)",
    ]

    def up(name: str, group: str, k: int) -> None:
        by = f"{group}, " if group else ""
        ctes.append(f"{name}{k + 1} AS (SELECT {by}pos // {FANOUT} AS pos, (any_value(n) + {FANOUT - 1}) // {FANOUT} AS n, "
                    f"sha256(string_agg(node, '' ORDER BY pos)) AS node FROM {name}{k} WHERE n > 1 GROUP BY {by}pos // {FANOUT})")

    def steps(name: str, out: str, group: str) -> None:
        w = f"PARTITION BY {group + ', ' if group else ''}pos // {FANOUT} ORDER BY pos ROWS BETWEEN"
        for k in range(levels + 1):
            ctes.append(f"{out}{k} AS (SELECT *, coalesce(string_agg(node, '') OVER ({w} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                        f"coalesce(string_agg(node, '') OVER ({w} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})")

    for k in range(levels):
        up("n", "source", k)
    ctes.append("subroots AS (" + " UNION ALL ".join(f"SELECT source, node FROM n{k} WHERE n = 1" for k in range(levels + 1)) + ")")
    ctes.append("u0 AS (SELECT source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, node FROM subroots)")
    for k in range(levels):
        up("u", "", k)
    ctes.append("root AS (" + " UNION ALL ".join(f"SELECT node AS root FROM u{k} WHERE n = 1" for k in range(levels + 1)) + ")")
    steps("n", "s", "source")
    steps("u", "v", "")
    joins, proof_parts, fold = [], [], "coalesce(s0.tampered, s0.node)"
    for k in range(levels + 1):
        if k:
            joins.append(f"LEFT JOIN s{k} ON s{k}.source IS NOT DISTINCT FROM s0.source AND s{k}.pos = s0.pos // {FANOUT ** k}")
        proof_parts.append(f"coalesce(s{k}.l || s{k}.r, '')")
        fold = f"CASE WHEN s{k}.n > 1 THEN sha256(s{k}.l || {fold} || s{k}.r) ELSE {fold} END" if k < 1 else fold
    ctes.append("f0 AS (SELECT s0.doc_id, s0.source, s0.node AS leaf, s0.pos, " + " || ".join(proof_parts) + f" AS proof, {fold} AS f FROM s0 {' '.join(joins)})")
    for k in range(1, levels + 1):
        ctes.append(f"f{k} AS (SELECT f.* REPLACE (CASE WHEN s.n > 1 THEN sha256(s.l || f.f || s.r) ELSE f.f END AS f) FROM f{k - 1} f "
                    f"LEFT JOIN s{k} s ON s.source IS NOT DISTINCT FROM f.source AND s.pos = f.pos // {FANOUT ** k})")
    ctes.append(f"w0 AS (SELECT f.doc_id, f.source, f.leaf, f.proof, f.f, v.node AS subroot, v.pos AS upos FROM f{levels} f JOIN v0 v ON v.source IS NOT DISTINCT FROM f.source)")
    for k in range(levels + 1):
        ctes.append(f"w{k + 1} AS (SELECT w.* REPLACE (w.proof || coalesce(v.l || v.r, '') AS proof, "
                    f"CASE WHEN v.n > 1 THEN sha256(v.l || w.f || v.r) ELSE w.f END AS f) FROM w{k} w LEFT JOIN v{k} v ON v.pos = w.upos // {FANOUT ** k})")
    return ("WITH " + ",\n".join(c.replace(" AS (", " AS MATERIALIZED (", 1) for c in ctes)
            + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM w{levels + 1}, root")


ORACLE = _oracle()
