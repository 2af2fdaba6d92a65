"""Medians by bracket selection against sorted lists."""

from __future__ import annotations

import random

import pytest

from shopline.operators import ordering
from shopline.operators.clean import impute

NAN = float("nan")


def plain(values: list) -> float | None:
    """Mean of the two middle values; NaN last, both zeros one value."""
    v = sorted((float(x) + 0.0 for x in values if x is not None), key=lambda x: (x != x, x))
    return (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 if v else None


def table(spark, columns: dict[str, list], partitions: int = 3):
    n = max(map(len, columns.values()))
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns)).repartition(partitions)


def check(spark, columns: dict[str, list], **how):
    got = {r["column"]: r["median"] for r in ordering.exact_medians(table(spark, columns), list(columns), **how).collect()}
    assert {c: repr(v) for c, v in got.items()} == {c: repr(plain(v)) for c, v in columns.items()}


def columns_of(seed: int) -> dict[str, list]:
    rng = random.Random(seed)
    n = 3001 - seed % 2
    return {
        "spread": [rng.uniform(-1e9, 1e9) for _ in range(n)],
        "hot": [7.0] * (n * 2 // 3) + [rng.uniform(-10, 10) for _ in range(n // 3)],
        "halves": [float(i % 2) for i in range(n + 1)],
        "steps": [float(rng.randrange(12)) for _ in range(n)],
        "one": [4.5],
        "two": [1.0, 2.0],
        "equal": [3.0] * n,
        "none": [],
        "some NaN": [NAN] * (n // 3) + [rng.random() for _ in range(n // 2)],
        "half NaN": [NAN] * 500 + [rng.random() for _ in range(500)],
        "most NaN": [NAN] * 501 + [rng.random() for _ in range(499)],
        "only NaN": [NAN] * 3,
        "infinite": [float("inf")] * 400 + [float("-inf")] * 300 + [rng.random() for _ in range(250)],
        "zeros": [-0.0, 0.0] * 100 + [1e-300],
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_medians(spark, seed):
    check(spark, columns_of(seed))


@pytest.mark.parametrize("bracket, accuracy", [(5, 10), (1, 3), (50, 20)])
def test_brackets_that_need_several_rounds(spark, bracket, accuracy):
    """A coarse sketch and a small bracket: narrowed again and again, and corrected where the sketch was off."""
    check(spark, columns_of(3), bracket=bracket, accuracy=accuracy)


def test_rounds_are_few(spark, monkeypatch):
    rounds = []
    kept = ordering._sketched
    monkeypatch.setattr(ordering, "_sketched", lambda *a: (rounds.append(1), kept(*a))[1])
    rng = random.Random(4)
    check(spark, {"v": [rng.gauss(0, 1) for _ in range(20_000)]}, bracket=100, accuracy=100)
    assert 1 < sum(rounds) <= 3


def test_nothing_is_stored_or_shuffled_by_value(spark, monkeypatch):
    monkeypatch.setattr(ordering, "cut_lineage", lambda df: pytest.fail("a table was stored"))
    check(spark, {"v": [1.0, 5.0, 2.0]})


def test_integers_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (2, None), (4, None), (None, None)], "a long, b int")
    out, audit = impute(df, ["a", "b"])
    assert sorted(map(tuple, out.collect()), key=repr) == [(1.0, None), (2.0, None), (2.0, None), (4.0, None)]
    assert {r["column"]: r["value_num"] for r in audit.collect()} == {"a": 2.0, "b": None}
    assert ordering.exact_medians(df.limit(0), ["a", "b"]).collect() == [("a", None), ("b", None)]
    assert ordering.exact_medians(df, []).collect() == []
