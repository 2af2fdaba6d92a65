from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopline.llm import op1_mcd as mcd
from shopline.llm import op2_langid as lid
from tests.llm.brute import text_stats

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_equal_brute_force(spark, edge, sf_docs):
    for docs in (edge, sf_docs):
        for r in mcd.text_statistics(docs.select("doc_id", "text")).collect():
            assert tuple(r[c] for c in STATS) == text_stats(r.text), r.doc_id


def test_query_rows_and_verdicts(spark, folder, sf_docs):
    rows = mcd.op1_mcd(spark, f"{folder}/full").collect()
    assert len(rows) == 16
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept in (True, False) and not (r.kept and r.base_failed)
    assert mcd.op1_mcd(spark, f"{folder}/empty").collect() == []


def mcd_numpy(x: np.ndarray, share: float, steps: int) -> np.ndarray:
    """The same estimate with exact h-subsets: squared distances."""
    n, p = x.shape
    h = int(np.ceil(share * n))
    unit = np.eye(p)
    med = np.median(x, 0)
    starts = [(x.mean(0), np.cov(x.T, bias=True) + unit), (med, np.diag((1.4826 * np.median(abs(x - med), 0)) ** 2) + unit)]
    best = None
    for m, s in starts:
        for _ in range(steps):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
            near = x[np.argsort(d)[:h]]
            m, s = near.mean(0), mcd.consistency(share, p) * np.cov(near.T, bias=True) + unit
        if best is None or np.linalg.det(s) < best[0]:
            best = (np.linalg.det(s), m, s)
    _, m, s = best
    d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
    near = x[d <= mcd.chi2_quantile(0.975, p)]
    m, s = near.mean(0), mcd.consistency(0.975, p) * np.cov(near.T, bias=True) + unit
    return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)


def test_distances_follow_the_exact_estimate(spark):
    rng = np.random.default_rng(4)
    clean = rng.normal(size=(900, 3)) @ np.array([[3, 1, 0], [0, 2, 1], [0, 0, 4.0]])
    bad = rng.normal(size=(100, 3)) + np.array([30, -30, 40])
    x = np.round(np.concatenate([clean, bad]), 6)
    rows = [(i, "en" if i % 7 else None, "s", *map(float, v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, lang string, source string, a double, b double, c double")
    got = {r.id: r for r in mcd.outliers(df, ["a", "b", "c"], min_group=100, cutoff=1e-4).collect()}
    large = [i for i in range(1000) if i % 7]
    want = mcd_numpy(x[large], mcd.SHARE_KEPT, mcd.STEPS)
    near = np.array([got[i].distance for i in large])
    assert np.allclose(near, want, rtol=0.1, atol=0.5)  # subsets differ by less than a bucket of distance
    assert all(got[i].outlier for i in range(900, 1000))
    assert sum(got[i].outlier for i in range(900)) <= 3


def test_equal_vectors_and_small_groups_are_kept(spark):
    df = spark.createDataFrame([(i, "en", "s", 1.0, 2.0) for i in range(300)] + [(999, "de", None, 50.0, 2.0)], "id int, lang string, source string, a double, b double")
    assert not any(r.outlier for r in mcd.outliers(df, ["a", "b"], min_group=100).collect())


def test_chi_square():
    assert abs(mcd.chi2_quantile(0.975, 5) - 12.8325) < 1e-3 and abs(mcd.chi2_cdf(9.2364, 5) - 0.9) < 1e-4


def parse_naive(text: str, corpus: str) -> int:
    count = at = 0
    while at < len(text):
        n = 1
        while at + n <= len(text) and text[at:at + n] in corpus:
            n += 1
        at += max(1, n - 1)
        count += 1
    return count


def test_phrases_equal_a_naive_parse():
    rng = random.Random(5)
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randint(1, 8)))
    corpora = {"x": " ".join(word("abcd") for _ in range(300)), "y": " ".join(word("cdef") for _ in range(200))}
    alphabet = sorted(set("".join(corpora.values())) - {" "})
    lut = lid.symbol_table(alphabet)
    edges = [tuple(a.tobytes() for a in lid.suffix_automaton(lid.to_symbols(c, lut).tolist())) for c in corpora.values()]
    parser = lid.Parser({"alphabet": alphabet, "langs": list(corpora), "chars": [len(c) for c in corpora.values()], "edges": edges})
    texts = [" ".join(word("abcdefg") for _ in range(rng.randint(0, 30)))[:lid.SEGMENT] for _ in range(60)] + ["", "a"]
    counts, _ = parser.phrases(texts)
    for text, row in zip(texts, counts.tolist(), strict=True):
        assert row == [parse_naive(text, c) for c in corpora.values()], text


def test_held_out_accuracy_and_bounds(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lid.op2_langid(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 300 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    sample = lid.training_sample(docs, "text", "lang", 5000, 12_000).groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()
    assert len(sample) == 4 and all(0 < r.n <= 3000 for r in sample)


def test_sample_fills_from_long_texts_and_copies(spark):
    text = F.rpad(F.concat("lang", F.lit(" "), "i"), F.col("n"), F.concat(F.lit(" word "), "i", F.lit(" of "), "lang"))
    long = spark.range(36).select((F.col("id") % 12).cast("string").alias("lang"), F.col("id").cast("string").alias("i"), F.lit(1_000_000).alias("n"))
    hot = spark.range(4000).select(F.lit("hot").alias("lang"), F.greatest("id", F.lit(3000)).cast("string").alias("i"),
                                   F.when(F.col("id") <= 3000, 2000).otherwise(40).alias("n"))
    docs = long.unionByName(hot).select("lang", text.alias("text"))
    sample = lid.training_sample(docs, "text", "lang", 20_000, 10_000_000).groupBy("lang").agg(F.sum(F.length("text")).alias("n"), F.count_distinct("text").alias("k"))
    got = {r.lang: (r.n, r.k) for r in sample.collect()}
    assert len(got) == 13 and all(n == 20_000 for n, _ in got.values()) and got["hot"][1] > 300


def test_all_letters_of_many_scripts_count(spark):
    rng = random.Random(7)
    letters = {"en": range(97, 123), "ru": range(0x430, 0x450), "bg": range(0x430, 0x450), "el": range(0x3B1, 0x3CA), "zh": range(0x4E00, 0x5C00),
               "ja": range(0x4E00, 0x5C00), "ko": range(0xAC00, 0xB800), "ar": range(0x627, 0x63B)}
    words = {lang: ["".join(chr(rng.choice(own)) for _ in range(rng.randint(2, 5))) for _ in range(300)] for lang, own in letters.items()}
    say = lambda lang, n: ("" if lang in ("zh", "ja") else " ").join(rng.choices(words[lang], k=n))
    train = [(lang, say(lang, 400)) for lang in letters for _ in range(10 if lang == "en" else 4)]
    model = lid.learn(spark.createDataFrame(train, "lang string, text string"))
    assert set(model["alphabet"]) == {c for _, t in train for c in t if c != " "}
    texts = [(lang, say(lang, 30)) for lang in letters for _ in range(10)]
    rows = lid.predict(spark.createDataFrame(texts, "lang string, text string"), model).collect()
    assert all(r.lang_pred == r.lang for r in rows)


def test_texts_without_letters_have_no_language(spark):
    """Numbers and signs that Unicode doesn't count as letters, however they look."""
    model = lid.learn(spark.createDataFrame([("en", "the house of the man"), ("fr", "la maison de la rue")], "lang string, text string"))
    texts = ["½", "² ①", "12 34", "_ - _", "①②③ ¼", "", " "]
    rows = lid.predict(spark.createDataFrame([(t,) for t in [*texts, "½ a", "ª"]], "text string"), model).collect()
    assert [(r.lang_pred, r.score) for r in rows[:len(texts)]] == [("und", 0.0)] * len(texts)
    assert all(r.lang_pred != "und" for r in rows[len(texts):])


def test_language_of_edge_rows(spark, edge, none, folder):
    model = lid.learn(edge)
    rows = lid.predict(edge.drop("score"), model).collect()
    assert len(rows) == 16
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("en", "fr")) == letters and (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert lid.op2_langid(spark, f"{folder}/empty").collect() == []
    assert {r.lang_pred for r in lid.predict(edge, lid.learn(none)).collect()} == {"und"}


@pytest.mark.parametrize("query", [mcd.op1_mcd])
def test_no_python_in_the_native_plan(spark, folder, query):
    text = query(spark, f"{folder}/full")._jdf.queryExecution().executedPlan().toString()
    assert not any(n in text for n in ("Python", "Pandas", "Arrow"))
