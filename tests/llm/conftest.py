from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, removed string, topic string, ids string, score string, label int"


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def edge_rows() -> list[tuple]:
    """Nulls, empty and blank texts, one word, a very long text, equal rows, equal ids, columns with clashing names."""
    prose = ["the house of the man that was by and for with her in a small town of old streets and new roads",
             "la maison de la rue est dans le village et les enfants sont avec leur mère pour la journée"]
    long = " ".join(f"{w}{i % 977}" for i in range(30_000) for w in ("of", "rain"))
    texts = [(1, None), (2, ""), (3, " \t\n\x0b\r "), (4, "word"), (5, prose[0] * 3), (6, prose[0] * 3), (6, prose[0] * 3), (7, prose[1] + "\n" + prose[0]),
             (7, prose[1]), (None, prose[1] + " encore"), (None, None), (8, long), (9, "12 34 !! ??"), (10, "x\x00y \x85z  w 漢字 😀"), (11, "a\r\nb\r\n\r\nc"),
             (12, "\n".join([prose[0]] * 5))]
    return [(i, t, ("en", "fr", None)[k % 3], ("s1", None)[k % 2], k, "r", "t", "i", "s", k) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def folder(spark, edge, tmp_path_factory):
    """The edge rows as the tables of a folder, and one of empty tables."""
    base = str(tmp_path_factory.mktemp("tables"))
    vectors = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [3.0, 0.5]), (100, None), (101, [1.0, float("nan")]), (102, [1.0, None]), (103, []),
               (104, [2.0, -1.0, 4.0]), (None, [9.0, 9.0]), (105, [float("inf"), 1.0]), (106, [3.0, 0.5])]
    pages = [(3, "u", "x" * 200), (1, "u\r\nv", "x" * 200), (1, None, "x" * 200), (None, "u", "x" * 200), (4, "u", None), (5, "u", "short"), (6, "u", "short"),
             (7, "u", "line\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n" * 40), (8, "u", "\r\n" * 100 + "\r"), (9, "u", "é" * 4000)]
    for name, rows in (("full", None), ("empty", [])):
        edge.filter("true" if rows is None else "false").write.parquet(f"{base}/{name}/documents.parquet")
        spark.createDataFrame(vectors if rows is None else [], "vec_id long, embedding array<float>").selectExpr(
            "*", "cast(1 as int) as label").write.parquet(f"{base}/{name}/embeddings.parquet")
        spark.createDataFrame(pages if rows is None else [], "page_id long, url string, html string").write.parquet(f"{base}/{name}/pages.parquet")
    return base
