"""Operators 11 to 13 against plain versions, SQL and edge rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shopline.llm import op11_variants as variants
from shopline.llm import op12_paths as paths
from shopline.llm import op13_merkle as merkle
from tests.llm import brute_new
from tests.llm.conftest import SF
from tools.oracle_check import compare, duck

OWN = {"op11_variants": variants, "op12_paths": paths, "op13_merkle": merkle}


def rows_of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op11_variants", "op13_merkle"])
def test_query_equals_its_sql(spark, name):
    df = getattr(OWN[name], name)(spark, SF)
    rel = duck(SF).execute(OWN[name].ORACLE)
    exact, _, msg = compare(list(map(tuple, df.collect())), df.columns, rel.fetchall(), [d[0] for d in rel.description])
    assert exact, msg


@pytest.mark.parametrize("name", sorted(OWN))
def test_empty_tables(spark, folder, name):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/empty/labels.parquet")
    assert getattr(OWN[name], name)(spark, f"{folder}/empty").collect() == []


# ------------------------------------------------------------------ variants

def test_variants_of_edge_rows(edge):
    rows = variants.roots(variants.forms(variants.stored(variants.vocabulary(edge))))
    got = rows_of(rows.select("word", "form", "root", "n", "n_near", "form_n"))
    want = brute_new.variants([(r.doc_id, r.text) for r in edge.collect()])
    assert got == sorted(want, key=repr) and got


def test_variants_of_words_one_and_two_edits_apart(spark):
    """Chains of forms, anagrams, repeated letters, accents, signs within the range, capitals, and long words."""
    rng = random.Random(5)
    base = ["painting", "aaaaaaab", "éléphants", "ÉLÉPHANTS", "stre×t÷sign", "abcabcabcabc", "x" * 300, "mirror" * 40]
    words = dict.fromkeys(base, 400)
    letters = "abcdeinptÉéß÷×"
    for w in base:
        for _ in range(25):
            at, how = rng.randrange(len(w)), rng.randrange(3)
            words[w[:at] + ("" if how == 0 else rng.choice(letters)) + w[at + (how != 1):]] = rng.choice([4, 5, 30, 79, 80, 81])
    for w in list(words)[8:60]:
        at = rng.randrange(len(w))
        words.setdefault(w[:at] + rng.choice(letters) + w[at + 1:], rng.choice([5, 6, 16]))
    docs = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())] + [(None, "Painting PAINTING " * 5), (7, None), (8, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2)).repartition(3)
    got = rows_of(variants.roots(variants.forms(variants.stored(variants.vocabulary(df)))).select("word", "form", "root", "n", "n_near", "form_n"))
    want = sorted(brute_new.variants(docs), key=repr)
    assert got == want
    assert any(w[2] not in (w[0], w[1]) for w in want), "no chain of two forms in the test"


def test_each_pair_comes_out_once(spark):
    words = spark.createDataFrame([(w, 5) for w in ["abcdef", "abcdeg", "abcdfe", "abcdefg", "bacdef", "aabcdef", "abcde", "fedcba", "zbcdef"]], "word string, n long")
    pairs = [tuple(sorted((r.word, r.other))) for r in variants.near_pairs(words).collect()]
    want = {tuple(sorted((a, b))) for a in [r.word for r in words.collect()] for b in [r.word for r in words.collect()] if brute_new.near(a, b)}
    assert sorted(pairs) == sorted(want)


# --------------------------------------------------------------------- paths

def pages_of(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        host = rng.choice(["a.example.org"] * 6 + ["b.example.com", "c.test", "example.net", "www.example.net", "notexample.net"])
        part = rng.choice(["news", "news", "blog", "tag"]) if host == "a.example.org" else rng.choice(["en", "de", "fr"])
        tail = {"tag": lambda: rng.choice(["spam", "offers", "cafe0123ab"]), "blog": lambda: f"post-{rng.randrange(999)}/{rng.choice(['print', ''])}"}
        path = f"/{part}/" + tail.get(part, lambda: f"{rng.randrange(10**6)}{rng.choice(['', '.html', '/'])}")()
        bad = 0.95 if part == "tag" else 0.1
        out.append((i, f"https://{host.upper() if i % 7 == 0 else host}{path}{rng.choice(['', '?q=1', '#top'])}", None if rng.random() < 0.4 else rng.random() > bad))
    return out


EDGE_PAGES = [(None, None, True), (1, "", None), (1, "no scheme", False), (2, "http://", True), (3, "http://EXAMPLE.net", None), (3, "http://EXAMPLE.net", None),
              (4, "http://example.net/en", None), (5, "http://example.net/en/", None), (6, "http://x.example.com/de/1?a=http://b.net/", None), (7, "http://aorg/fr/1", None),
              (8, "http://a.org/fr/", None), (9, "http://a.org:80/fr/", None), (10, "http://a.org//fr//", None), (11, "x://" + "h" * 3000 + "/" + "a/" * 5000, None),
              (12, "http://e.org/a\nb/ü.html\r\n?x", True), (13, "http://.net/", None), (14, "a://b://c/d", None), (15, "http://u.test/%20/é.jpeg", None), (16, "http://É.net/", None)]


@pytest.mark.parametrize("support", [2, 20])
def test_paths_equal_the_plain_version(spark, support, monkeypatch):
    monkeypatch.setattr(paths, "SUPPORT", support)
    pages = pages_of(3, 3000) + EDGE_PAGES + [(99, "http://a.example.org/hot/1", False)] * 40
    df = spark.createDataFrame([(*p, "h", "p", "t") for p in pages], "page_id long, url string, good boolean, host string, path string, template string").repartition(3)
    got = paths.filtered(df, good=F.col("good")).select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 9))
    want = brute_new.paths(pages, support)
    assert rows_of(got) == want
    verdicts = {r[5]: r[4] for r in want if r[1] == "a.example.org" and r[3] is None}
    assert len(verdicts) > 3 and set(verdicts.values()) == {"allow", "block"}
    if support == 20:
        assert any("*" in t for t in verdicts), "no branches merged in the test"


def test_paths_query(spark):
    got = paths.op12_paths(spark, SF)
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    labels = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    plain = []
    for i, url in pages.items():
        number = brute_new.re.search("/([0-9]+)", brute_new.split_url(url)[1])
        plain.append((i, url, labels.get(int(number.group(1))) if number else None))
    got = got.select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 9))
    assert rows_of(got) == brute_new.paths(plain, paths.SUPPORT)


def test_paths_main_path_is_native(spark):
    plan = paths.op12_paths(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -------------------------------------------------------------------- merkle

def test_merkle_of_edge_rows(spark, edge, folder):
    got = rows_of(merkle.op13_merkle(spark, f"{folder}/full"))
    want = brute_new.merkle([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in edge.collect()])
    assert got == want


@pytest.mark.parametrize("sizes", [[1], [17, 1, 2, 16], [1] * 17, [4113, 33, 256]])
def test_merkle_of_group_sizes(spark, sizes):
    """Lone leaves, whole runs, a last run of one, several levels, and several levels of subroots."""
    names = [None, "", "é", "z", *[f"s{i:02}" for i in range(20)]]
    rng = random.Random(1)
    docs = [(i, names[g], "l", None, f"Text {i}") for g, n in enumerate(sizes) for i in range(n)]
    docs += docs[:3] if len(docs) > 20 else []
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    own = {c: F.col(c) for c in merkle.COLUMNS}
    rows, root, levels = merkle.manifest(df, "doc_id", "source", {"leaf": merkle.leaf(list(own.values()))})
    got = rows_of(rows.select("doc_id", "leaf", "subroot", F.lit(root), F.sha2(merkle.proof(), 256), merkle.folded(F.col("leaf"))))
    want = sorted([(*w[:5], w[3]) for w in brute_new.merkle(docs)], key=repr)
    assert got == want
