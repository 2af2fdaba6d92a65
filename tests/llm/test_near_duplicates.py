from __future__ import annotations

import random

import pytest

from shopline.llm import op6_lines as lines
from shopline.llm import op7_trees as trees
from shopline.llm.components import components
from tests.llm.brute import near_components, redundant_lines
from tests.llm.conftest import edge_rows


def variants(seed: int, groups: int, size: int, words: int, edits: int) -> list[str]:
    """Groups of texts that differ from their base in some words, shuffled."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    shared, out = [word() for _ in range(30)], []
    for g in range(groups):
        base = [word() for _ in range(words)] + (shared if g % 2 else [])
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = word()
            out.append(" ".join(text))
    rng.shuffle(out)
    return out


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 200)] + [(5, 5), (300, 301), (301, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 10 for i in range(10, 61)} | {i: 100 for i in range(100, 200)} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def marked(df) -> dict:
    return {r.doc_id: set(r.removed) for r in lines.mark_lines(df.select("doc_id", "text")).select("doc_id", "removed").collect() if r.removed}


def test_lines_equal_brute_force(spark, sf_docs):
    rows = [(r.doc_id, r.text) for r in sf_docs.collect()]
    want = redundant_lines(rows, lines.SHINGLE, lines.THRESHOLD, lines.MIN_CHARS)
    assert marked(sf_docs) == {k: v for k, v in want.items() if v}


def test_lines_without_blanks_and_long_words(spark):
    rng = random.Random(3)
    some = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    cjk = [chr(c) for c in range(0x4E00, 0x4E00 + 800)]
    url = "https://example.com/" + some("abcdefgh/", 60)
    compound = ["Donaudampf" + some("abcdefgh", 30) for _ in range(6)]
    texts = ["https://example.com/" + some("abcdefgh/", 60) for _ in range(4)]  # equal starts, other texts
    texts += [url, "h" + url[1:-1] + "?", "xy" + url]  # near copies, one with another start
    texts += ["".join(cjk[:12]) + some(cjk, 40) for _ in range(4)] + [some(cjk, 60) + "😀"]
    texts += ["一" + texts[-1], " ".join(compound), " ".join(w[:14] + some("abcdefgh", 26) for w in compound)]
    docs = list(enumerate(texts))
    want = {k: v for k, v in redundant_lines(docs, lines.SHINGLE, lines.THRESHOLD, lines.MIN_CHARS).items() if v}
    assert marked(spark.createDataFrame(docs, "doc_id long, text string")) == want == {5: {0}, 6: {0}, 12: {0}}


def test_short_equal_lines(spark):
    """Equal lines go however short; unlike short ones stay, and so do blank ones."""
    texts = ["Share this article\nfirst", "second\nShare this article\n \n", "Share this  article\n}\n\nx", "}\nShare that article", "x\nx", None, ""]
    got = marked(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert got == {1: {1}, 2: {0}, 3: {0}, 4: {0, 1}}  # runs of blanks count as one
    some = lines.mark_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), min_chars=15)
    assert {r.doc_id: set(r.removed) for r in some.collect() if r.removed} == {1: {1}, 2: {0}}


def test_recall_by_length(spark):
    """Pairs at the threshold, from lines of a shingle or two to long ones, with many, few and no sampled shingles."""
    rng, docs = random.Random(8), []
    for size in (14, 24, 40, 80, 200, 900):
        for k in range(60):
            alphabet = ("abcdefghijklmnopqrstuvwxyz ", "abdeghjkmn", "一二三四五六七八九十百千万")[k % 3]
            line = "".join(rng.choice(alphabet) for _ in range(size)).strip()
            cut = rng.randrange(1, max(2, (size - 11) // 9))
            docs.append((len(docs), line + "\n" + line[cut:]))
    want = {k: v for k, v in redundant_lines(docs, lines.SHINGLE, lines.THRESHOLD, lines.MIN_CHARS).items() if v}
    got = marked(spark.createDataFrame(docs, "doc_id long, text string"))
    assert not any(v - want.get(k, set()) for k, v in got.items())
    found = sum(map(len, got.values())) / sum(map(len, want.values()))
    assert len(want) > 200 and found >= 0.98, found


def test_similar_lines_in_large_groups(spark):
    texts = variants(1, groups=6, size=60, words=40, edits=4)
    docs = [(i, "\n".join(texts[i::90])) for i in range(90)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want, got = redundant_lines(docs, lines.SHINGLE, lines.THRESHOLD, lines.MIN_CHARS), marked(df)
    missed = sum(len(want[i] - got.get(i, set())) for i in list(want))
    assert not any(got.get(i, set()) - want[i] for i in got) and missed <= 0.1 * sum(map(len, want.values()))  # chains of pairs just above the threshold


def test_all_members_of_a_bucket_are_connected_or_compared(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(lines, "with_bands", lambda rows: rows.withColumn("bands", F.array(F.lit(1).cast("long"))))
    rng, texts = random.Random(11), []
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    for _ in range(8):  # chains: each text is like the one before, and soon unlike the first
        chain = [word() for _ in range(40)]
        for _ in range(20):
            chain[rng.randrange(40)] = word()
            texts.append(" ".join(chain))
    docs = list(enumerate(texts))
    want = {k: v for k, v in redundant_lines(docs, lines.SHINGLE, lines.THRESHOLD, lines.MIN_CHARS).items() if v}
    assert marked(spark.createDataFrame(docs, "doc_id long, text string")) == want and len(want) > 100


def test_line_dedup_of_edge_rows(spark, edge, none, folder):
    kept = lines.dedup_lines(edge)
    assert [c for c in kept.columns if c != "n_kept_lines"] == [c for c in edge.columns if c != "removed"]
    rows = kept.collect()
    assert len(rows) == len(edge_rows())
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert {r.text for r in by_id[1]} == {None} and {r.text for r in by_id[2]} == {""}
    assert len({r.text for r in by_id[6]}) == 1  # equal rows are one document
    assert by_id[12][0].text.count("\n") == 0 or by_id[12][0].text == ""
    assert lines.dedup_lines(none).collect() == [] and lines.op6_lines(spark, f"{folder}/empty").collect() == []


def test_no_python_in_the_native_plan(spark, folder):
    text = lines.op6_lines(spark, f"{folder}/full")._jdf.queryExecution().executedPlan().toString()
    assert not any(n in text for n in ("Python", "Pandas", "Arrow"))


def found(df) -> dict:
    return {r.doc_id: (r.n_shingles, r.component_id) for r in trees.near_duplicates(df).collect()}


def test_trees_equal_brute_force(spark, sf_docs):
    assert found(sf_docs) == near_components([(r.doc_id, r.text) for r in sf_docs.collect()])


@pytest.mark.parametrize("small_blocks", [False, True])
def test_trees_on_groups_around_the_threshold(spark, monkeypatch, small_blocks):
    if small_blocks:  # every path of the join: blocks of labels, and grids of blocks
        monkeypatch.setattr(trees, "BLOCK", 7)
        monkeypatch.setattr(trees, "MANY_LABELS", 3)
    docs = list(enumerate(variants(2, groups=8, size=30, words=60, edits=5) + ["a b c d e f", "A B c d e f", "a b", "a  b", "", " ", "x y z"]))
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == near_components(docs)


def test_trees_on_edge_rows(spark, edge, none, folder):
    rows = trees.op7_trees(spark, f"{folder}/full").collect()
    assert len(rows) == len(edge_rows())
    own = {r.doc_id: r for r in rows}
    assert (own[1].n_shingles, own[1].component_id) == (0, 1) and (own[3].n_shingles, own[3].component_id) == (0, 3)
    assert own[4].n_shingles == 1 and own[6].component_id == 5 and own[8].n_shingles > 1_000
    assert trees.op7_trees(spark, f"{folder}/empty").collect() == [] and trees.one_of_each(none).collect() == []
    left = trees.one_of_each(edge)
    assert left.columns == edge.columns
    ids = [r.doc_id for r in left.collect()]
    assert ids.count(6) == 0 and ids.count(5) == 1 and ids.count(1) == 1 and ids.count(2) == 1


def test_unlike_lines_of_a_large_bucket_are_few_pairs(spark, monkeypatch):
    """Lines that share a passage, and near copies of one text that are unlike each other:
    not their squares are compared, and no link is lost."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(lines, "with_bands", lambda rows: rows.withColumn("bands", F.array(F.lit(1).cast("long"))))
    rng, met = random.Random(12), []
    compared = lines._compared
    monkeypatch.setattr(lines, "_compared", lambda pairs, *a: (met.append(pairs.select("id", "r").distinct().count()), compared(pairs, *a))[1])
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage, texts = [word() for _ in range(20)], []
    for k in range(120):
        text = passage + [word() for _ in range(10)] if k % 2 else [word() if rng.random() < 0.15 else w for w in passage + passage[::-1]]
        texts.append(" ".join(text))
    texts += [texts[1][:-3] + "xyz", texts[0][3:], texts[51][9:] + " abc"]
    docs = list(enumerate(texts))
    want = {k: v for k, v in redundant_lines(docs, lines.SHINGLE, lines.THRESHOLD, lines.MIN_CHARS).items() if v}
    assert marked(spark.createDataFrame(docs, "doc_id long, text string")) == want and len(want) >= 3
    assert sum(met) <= 6 * len(docs), met


def test_scan_is_linear_in_a_line_without_sampled_characters(spark):
    """A long line whose end has no sampled character is not scanned once from each of its characters."""
    import time

    docs = spark.createDataFrame([(k, f"{k} istanbul and more words to begin with " + "z" * 200_000) for k in range(2)], "doc_id long, text string")
    spots = lines.occurrences(docs, "doc_id", "text", 1)
    lines.with_bands(spots.limit(0)).collect()
    began = time.time()
    assert lines.with_bands(spots).filter("size(bands) > 0").count() == 2
    assert time.time() - began < 20


def test_trees_move_all_sets_once_before_the_rest(spark, monkeypatch):
    """One collapse, and the two joins of the rest: each moves the sets, which are most of the disk."""
    moved, with_sets = [], trees._with_sets
    monkeypatch.setattr(trees, "_with_sets", lambda *a: (moved.append(1), with_sets(*a))[1])
    docs = list(enumerate(variants(5, groups=6, size=20, words=60, edits=5)))
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == near_components(docs)
    assert len(moved) <= 3
