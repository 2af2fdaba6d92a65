from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopline.llm import op8_pii as pii
from shopline.llm import op9_bpe as bpe
from shopline.llm import op10_mixing as mix
from tests.llm.conftest import edge_rows


@pytest.fixture(scope="module")
def reference():
    import tiktoken
    path, pattern = bpe.vocabulary()
    return tiktoken.Encoding("reference", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def test_pieces_equal_the_library(reference):
    pairs, rng = bpe.BytePairs(bpe.read_ranks(bpe.vocabulary()[0])), random.Random(8)
    for _ in range(4000):
        alphabet = rng.choice(["ab", "aeiou ", "the and", "éèaü", "0123456789", "!-= \n", "日本語テスト한국", "\x00\xff́"])
        piece = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))).encode()
        assert pairs.encode(piece) == reference._core_bpe.encode_single_piece(piece)
    assert pairs.encode(b"a" * 50_000) == reference._core_bpe.encode_single_piece(b"a" * 50_000)


def test_documents_equal_the_library(spark, folder, sf_docs, reference, monkeypatch):
    for path, texts in ((f"{folder}/full", edge_rows()), ("/root/testdata/sf0.001", [(r.doc_id, r.text) for r in sf_docs.collect()])):
        want = []
        for row in texts:
            ids = np.array(reference.encode_ordinary(row[1] or ""), "<u4")
            want.append((row[0], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((row[1] or "").encode()).hexdigest()))
        assert sorted(map(tuple, bpe.op9_bpe(spark, path).collect()), key=repr) == sorted(want, key=repr)
    assert bpe.op9_bpe(spark, f"{folder}/empty").collect() == []


def test_long_texts_are_streamed(reference, monkeypatch):
    path, pattern = bpe.vocabulary()
    text = " ".join(f"word{i}" for i in range(5000))
    monkeypatch.setattr(bpe, "STREAM", 100)
    assert bpe._encoder(path, pattern)(text) == np.array(reference.encode_ordinary(text), "<u4").tobytes()


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")


def plain_spans(text: str) -> list:
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[ -]", "", m.group())
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in pii.PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_rules_equal_the_plain_expressions():
    rng = random.Random(9)
    for _ in range(20_000):
        text = "".join(rng.choice("a@.-1 25+()_%\n4") for _ in range(rng.randint(0, 40)))
        assert pii.rule_spans(text) == plain_spans(text), text


def test_field_learns_its_table_and_viterbi_is_exact():
    w, trans = pii.field()
    rng = np.random.default_rng(3)
    for features, tags in pii.training_table():
        own = features - pii._OFFSETS[:, None]
        assert (pii.decode(own, np.zeros(len(tags), int), w, trans) == tags).all()
    lengths = [1, 3, 2, 4]
    features = np.stack([rng.integers(0, n, sum(lengths)) for n in pii.GROUPS]).astype(np.int32)
    got = pii.decode(features, np.repeat(range(4), lengths), w, trans)
    emit, at, tags = w[(features + pii._OFFSETS[:, None]).T].sum(1), 0, range(len(pii.TAGS))
    from itertools import product
    for n in lengths:
        paths = [p for p in product(tags, repeat=n) if pii.TAGS[p[0]][0] != "I"]
        value = lambda p: sum(emit[at + i][t] for i, t in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))  # noqa: B023,E731
        assert abs(max(map(value, paths)) - value(tuple(got[at:at + n].tolist()))) < 1e-3
        at += n


def test_added_spans_are_valid_and_apart(spark):
    texts = ["of 2353820953013749 4550997810720808 the", "Des +1 (826) 555-4081 190.137.223.204 du", "the 9807915762804490 of",
             "the house of the man", "on 2023-05-17 at 10:30, 12 of 250", "mail a.b@mail.example.com now"]
    rows = [r.spans for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)).orderBy("i").collect()]
    assert rows[0] == "card:20:36" and rows[1] == "phone:4:21,ip:22:37" and rows[2:5] == ["", "", ""] and rows[5] == "email:5:25"


def test_personal_data_of_edge_rows(spark, folder):
    rows = pii.op8_pii(spark, f"{folder}/full").collect()
    assert len(rows) == len(edge_rows()) and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() and r.n_email == 0 for r in rows)
    assert pii.op8_pii(spark, f"{folder}/empty").collect() == []


def cells_frame(spark, feasible: bool):
    rng = random.Random(2)
    rows = [(s, lang, t, rng.randint(50, 500) * (20 if s == "hot" else 1)) for s in ("hot", "a", None) for lang in ("en", "fr", None) for t in ("x", "y")]
    return spark.createDataFrame(rows if feasible else rows[:7], "source string, lang string, topic string, tokens long")


def test_raking_equals_plain_fitting(spark):
    cells = cells_frame(spark, True)
    targets = {m: mix.tempered(cells, m, 0.9) for m in mix.MARGINS}
    got = mix.rake(cells, targets, keep=0.4).toPandas()
    share = {m: {r.value: r.share for r in targets[m].collect()} for m in mix.MARGINS}
    for m in mix.MARGINS:
        assert abs(sum(share[m].values()) - 1) < 1e-12
        for value, part in got.groupby(m, dropna=False):
            key = None if value != value or value is None else value
            assert abs(part.weight.sum() - share[m][key]) < 1e-3
    assert ((got.probability >= 0) & (got.probability <= 1)).all()
    assert abs((got.probability * got.tokens).sum() - 0.4 * got.tokens.sum()) < 0.002 * got.tokens.sum()
    # raking scales by one factor a value: odds ratios within the table stay
    t = got.pivot_table(index=["source", "lang"], columns="topic", values=["weight", "tokens"], dropna=False)
    ratio = (t["weight"]["x"] / t["weight"]["y"]) / (t["tokens"]["x"] / t["tokens"]["y"])
    assert ratio.max() / ratio.min() - 1 < 1e-6


def test_unmet_targets_end_and_zero_targets_drop(spark):
    cells = cells_frame(spark, False)
    only = spark.createDataFrame([("hot", 1.0)], "value string, share double")
    got = mix.rake(cells, {m: mix.tempered(cells, m) if m != "source" else only for m in mix.MARGINS}).collect()
    assert all(r.probability == 0 for r in got if r.source != "hot") and any(r.probability > 0 for r in got)


def plain_raking(rows: list, sweeps: int) -> dict:
    """Weights by cell after so many sweeps; rows as of the result of rake."""
    total = sum(r.tokens for r in rows)
    weight = {tuple(r[m] for m in mix.MARGINS): r.tokens / total for r in rows}
    for _ in range(sweeps):
        for k, m in enumerate(mix.MARGINS):
            have = {}
            for c, w in weight.items():
                have[c[k]] = have.get(c[k], 0) + w
            to = {r[m]: r[f"to_{m}"] for r in rows}
            weight = {c: w * to[c[k]] / have[c[k]] if have[c[k]] else 0.0 for c, w in weight.items()}
        weight = {c: min(w, r.most) for (c, w), r in zip(weight.items(), rows, strict=True)}
    return weight


def test_raking_goes_on_after_a_target_that_cannot_be_met(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(f"s{s}", f"l{x}", f"t{t}", rng.randint(20, 60) * (200 if s == x == t else 1)) for s in range(3) for x in range(3) for t in range(3)]
    cells = spark.createDataFrame([*rows, ("s0", "l0", None, 50)], "source string, lang string, topic string, tokens long")
    share = lambda m, first: spark.createDataFrame([(None, 0.1) if m == "topic" else ("none", 0.0), *[(f"{m[0]}{i}", p) for i, p in enumerate(first)]], "value string, share double")
    targets = {"source": share("source", [0.2, 0.3, 0.5]), "lang": share("lang", [0.5, 0.3, 0.2]), "topic": share("topic", [0.3, 0.3, 0.3])}
    got = mix.rake(cells, targets, keep=0.05).collect()
    want = plain_raking(got, 3000)
    off = [abs(r.weight - want[tuple(r[m] for m in mix.MARGINS)]) for r in got]
    assert max(off) < 1e-4, max(off)
    monkeypatch.setattr(mix, "MAX_SWEEPS", mix.SWEEPS_A_STEP)  # Spark's sweeps are the same ones
    monkeypatch.setattr(mix, "HELD", 0)
    got = mix.rake(cells, targets, keep=0.05).collect()
    want = plain_raking(got, mix.SWEEPS_A_STEP)
    assert all(abs(r.weight - want[tuple(r[m] for m in mix.MARGINS)]) < 1e-12 for r in got)


def test_draws_follow_the_probabilities(spark):
    docs = spark.range(40_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source", "if(id % 5 = 0, null, 'en') as lang",
                                          "string(id % 4) as topic", "10 + id % 90 as n_tokens")
    rows = mix.with_probabilities(docs, mix.calibrated_cells(docs))
    sums = rows.groupBy("source").agg(F.sum(F.col("probability") * F.col("n_tokens")).alias("want"),
                                      F.sum(F.when(F.col("sampled"), F.col("n_tokens")).otherwise(0)).alias("got")).collect()
    assert all(abs(r.got - r.want) < 0.06 * r.want for r in sums)
    again = mix.with_probabilities(docs.repartition(7), mix.calibrated_cells(docs.repartition(3)))
    assert again.filter("sampled").count() == rows.filter("sampled").count()


def test_mixing_of_edge_rows(spark, folder):
    rows = mix.op10_mixing(spark, f"{folder}/full").collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.probability <= 1 for r in rows)
    assert all(r.probability == 0 and not r.sampled for r in rows if r.n_tokens == 0)
    assert mix.op10_mixing(spark, f"{folder}/empty").collect() == []
