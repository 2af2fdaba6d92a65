from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from functools import lru_cache

from pyspark.sql import functions as F

from shopline.llm import op3_lattice as lat
from shopline.llm import op4_warc as warc
from shopline.llm import op5_maxscore as ms
from tests.llm.brute import WORD, lower_ascii


def test_marginal_sums_all_segmentations():
    pieces = ["<unk>", "<0xC3>", "<0xA9>", "▁", "▁a", "a", "b", "ab", "▁ab", "bb", "aba"]
    scores = [math.log(p) for p in (0.01, 0.02, 0.03, 0.1, 0.2, 0.15, 0.05, 0.12, 0.14, 0.08, 0.1)]
    of = dict(zip(pieces, scores, strict=True))
    lattice = lat.Lattice(pieces, scores)

    @lru_cache(None)
    def total(s: str) -> float:
        if not s:
            return 1.0
        out = sum(math.exp(of[p]) * total(s[len(p):]) for p in pieces if s.startswith(p))
        return out + (0.02 * 0.03 * total(s[1:]) if s[0] == "é" else 0)

    for word in ("a", "b", "ab", "abab", "aébba", "ababbabaéé"):
        assert math.isclose(lattice.word_log10(word), math.log10(total("▁" + word)), rel_tol=1e-12)


def test_pieces_that_begin_like_special_ones_count():
    pieces = ["<unk>", "<s>", "</s>", "<0x3C>", "<0x2F>", "▁", "<", "</", "p", ">", "p>", "▁<", "a", "b"]
    scores = [math.log(p) for p in (0.01, 0.01, 0.01, 1e-9, 1e-9, 0.1, 0.07, 0.05, 0.1, 0.08, 0.06, 0.04, 0.2, 0.15)]
    of = {p: math.exp(s) for p, s in zip(pieces, scores, strict=True) if p not in ("<unk>", "<s>", "</s>", "<0x3C>", "<0x2F>")}
    of["/"] = 1e-9  # by its byte piece

    @lru_cache(None)
    def total(s: str) -> float:
        return sum(q * total(s[len(p):]) for p, q in of.items() if s.startswith(p)) if s else 1.0

    for word in ("</p>", "a<b", "<", "<p>ab</p>", "</p"):
        assert math.isclose(lat.Lattice(pieces, scores).word_log10(word), math.log10(total("▁" + word)), rel_tol=1e-12)


def test_all_text_pieces_of_the_given_vocabulary_are_used():
    import sentencepiece
    vocab = sentencepiece.SentencePieceProcessor(model_file=lat.piece_model())
    pieces = [vocab.id_to_piece(i) for i in range(vocab.get_piece_size())]
    lattice = lat.Lattice(pieces, [0.0] * len(pieces), lat.piece_kinds(vocab))
    missing = {p for p in pieces if p not in lattice.trie}
    assert all(vocab.is_unknown(i) or vocab.is_control(i) or vocab.is_byte(i) or vocab.is_unused(i) for i, p in enumerate(pieces) if p in missing)
    assert {"<", "</"} <= set(pieces) - missing and len(lattice.byte) == 256


def test_scores_equal_brute_force(spark, folder):
    path = f"{folder}/full"
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    tokens = lambda t: WORD.findall(lower_ascii(t or "")) + ["<end>"]
    trains = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 != 0
    seen = Counter(w for r in rows if trains(r.doc_id) for w in tokens(r.text))
    n, v = sum(seen.values()), len(seen)
    want = sorted((r.doc_id or -1, len(tokens(r.text)), sum(seen[w] > 0 for w in tokens(r.text)), n,
                   round(sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(r.text)), 6)) for r in rows)
    got = lat.op3_lattice(spark, path).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.held_out == (not trains(r.doc_id)) for r in got)
    ends = {round(r.score, 9) for r in got if r.n_tokens == 1}
    assert len(ends) == 1 and all(r.score <= 0 for r in got)
    assert lat.op3_lattice(spark, f"{folder}/empty").collect() == []


def test_rare_words_are_joined_as_the_hot_ones(spark, folder, monkeypatch):
    a = sorted(map(tuple, lat.op3_lattice(spark, f"{folder}/full").collect()), key=repr)
    monkeypatch.setattr(lat, "HOT", 3)
    b = sorted(map(tuple, lat.op3_lattice(spark, f"{folder}/full").collect()), key=repr)
    for x, y in zip(a, b, strict=True):
        assert x[:5] == y[:5] and math.isclose(x[5], y[5], rel_tol=1e-9) and math.isclose(x[6], y[6], rel_tol=1e-9)


def test_archive_query_equals_a_plain_version(spark, folder):
    pages = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{folder}/full/pages.parquet").collect()]
    first = {}
    for i, b in pages:
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    want = []
    for i, b in pages:
        revisit = b in first and i != first[b]
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first[b] if revisit else None))
    assert sorted(map(tuple, warc.op4_warc(spark, f"{folder}/full").collect()), key=repr) == sorted(want, key=repr)
    assert warc.op4_warc(spark, f"{folder}/empty").collect() == []


def test_chunks_carry_running_digests(spark, folder, tmp_path):
    pages = spark.read.parquet(f"{folder}/full/pages.parquet").filter("page_id in (7, 8, 9, 4)")
    for size in (7, 64, 1 << 20):
        path = str(tmp_path / str(size))
        warc.write_archives(pages, path, "page_id", "html", "url", chunk_bytes=size)
        rows = warc.read_chunks(spark, path).orderBy("record_id", "chunk_no").collect()
        for page in pages.collect():
            body, mine = (page.html or "").encode(), [r for r in rows if r.record_id == str(page.page_id)]
            assert b"".join(r.chunk for r in mine) == body and [r.chunk_no for r in mine] == list(range(len(mine)))
            at = 0
            for r in mine:
                at += len(r.chunk)
                assert len(r.chunk) <= size and r.bytes_so_far == at and r.digest_so_far == hashlib.sha256(body[:at]).hexdigest()
                assert r.is_last == (at == len(body))
    assert warc.read_chunks(spark, path).filter("is_last and digest_so_far != declared_digest").count() == 0


def search_naive(rows: list[tuple[int, list[int]]], k: int) -> list[tuple]:
    out = []
    for q, w in rows:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in rows if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_search_of_edge_vectors(spark, folder):
    rows = spark.read.parquet(f"{folder}/full/embeddings.parquet").collect()
    sound = [(r.vec_id, [math.floor(256 * x) for x in r.embedding]) for r in rows
             if r.vec_id is not None and r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)]
    assert sorted(map(tuple, ms.op5_maxscore(spark, f"{folder}/full").collect())) == search_naive(sound, 5)
    assert ms.op5_maxscore(spark, f"{folder}/empty").collect() == []


def test_search_over_many_shards_and_large_weights(spark, monkeypatch):
    monkeypatch.setattr(ms, "SEED_ROWS", 8)
    for spread in (900, 1 << 40):
        vectors = spark.range(600).selectExpr("id", f"transform(sequence(1, 12), j -> pmod(xxhash64(id % 550, j), {2 * spread}) - {spread}) as w")
        pack = ms.pack
        monkeypatch.setattr(ms, "pack", lambda rows: pack(rows, 64))
        got = sorted(map(tuple, ms.search(vectors, vectors.filter("id % 50 = 0"), 5).collect())) if spread == 900 else None
        monkeypatch.setattr(ms, "pack", pack)
        if got is None:  # scores beyond 64 bits don't fit the result; one shard's exact arithmetic is what counts
            import numpy as np
            data = [list(r.w) for r in vectors.orderBy("id").limit(50).collect()]
            shard = ms.Shard(np.arange(50, dtype="<i8").tobytes(), np.array(data, "<i8").tobytes(), 50, 12)
            rows, total, _ = shard.scores(np.array(data[0]), 5, -np.inf, 0)
            assert [int(t) for t in total] == [sum(a * b for a, b in zip(data[0], data[i], strict=True)) for i in rows.tolist()]
        else:
            assert got == search_naive([(r.id, list(r.w)) for r in vectors.collect()], 5)


def test_hash_remainders_are_crc32(spark):
    from shopline.llm.common import residue
    rows = spark.range(200).select("id", residue(F.col("id"), 10).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 10 for r in rows)
