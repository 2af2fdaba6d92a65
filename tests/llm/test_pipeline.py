from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline as cp
from shopline.llm import op6_lines as lines
from tests.llm.brute import WORD, near_components, redundant_lines
from tests.llm.conftest import SF, edge_rows


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_duplicates", "mixing", "tokenize"] and cp.ORACLE_SQL is None


@pytest.mark.parametrize("rows", ["edge", "none"])
def test_stages_keep_columns_and_bear_edge_rows(spark, folder, edge, none, rows):
    docs = edge if rows == "edge" else none
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, f"{folder}/full")
        assert out.schema.names == docs.schema.names, name
        assert out.count() <= (len(edge_rows()) if rows == "edge" else 0)
    last = cp.tokenize(spark, docs, f"{folder}/full").collect()
    assert len(last) == (len(edge_rows()) if rows == "edge" else 0) and all(r.round_trip for r in last if r.round_trip is not None)


def test_run_equals_plain_stages(spark, folder):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    texts = {i: r.text for i, r in docs.items() if any(c.isalpha() for c in r.text or "")}
    gone = redundant_lines(list(texts.items()), lines.SHINGLE, lines.THRESHOLD, lines.MIN_CHARS)
    texts = {i: "\n".join(x for at, x in enumerate(t.split("\n")) if at not in gone[i]) for i, t in texts.items()}
    texts = {i: t for i, t in texts.items() if WORD.search(t)}
    left = {i for i, (_, c) in near_components(list(texts.items())).items() if i == c}

    got = cp.run(spark, SF).collect()
    ids = [r.doc_id for r in got]
    assert len(set(ids)) == len(ids) and set(ids) <= left and len(ids) >= 0.5 * len(left)
    import tiktoken

    from shopline.llm import op9_bpe as bpe
    path, pattern = bpe.vocabulary()
    encoding = tiktoken.Encoding("reference", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    for r in got:
        assert r.round_trip and np.frombuffer(r.ids, "<u4").tolist() == encoding.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) // 4
    assert sorted(map(tuple, got)) == sorted(map(tuple, cp.run(spark, SF).collect()))
