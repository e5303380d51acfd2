import hashlib

import numpy as np
import public_tokenizers
import pytest

from tessera.llm import bpe, bpe_queries

PATH, PATTERN = public_tokenizers.path(bpe_queries.VOCABULARY), public_tokenizers.PATTERN


def whole(text):
    return np.array(bpe.vocabulary(PATH, PATTERN)[0].encode_ordinary(text or ""), "<u4").tobytes()


def test_equals_the_library_on_odd_rows(odd):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_queries.digests(odd).collect())
    want = []
    for r in odd.collect():
        ids = whole(r.text)
        want.append((r.doc_id is None, r.doc_id or 0, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)


@pytest.mark.parametrize("chunk,overlap", [(40, 16), (64, 8), (25, 20)])
def test_chunks_stitch_to_the_whole(spark, chunk, overlap):
    texts = ["it's a test   of 12345 chunks, isn't it?  \n\n yes " * 30, "a" * 500, " " * 300 + "b" + " " * 77, "日本語のテキスト" * 60,
             "word " * 10 + "x" * 200 + " end of it all " * 9, "!?" * 150 + "don't " * 50]
    df = spark.createDataFrame([(i % 4, t, "kept") for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string, chunk_no string")
    got = sorted((r.doc_id, bytes(r.ids)) for r in bpe.encode_documents(df, PATH, PATTERN, chunk_chars=chunk, overlap=overlap).collect())
    assert got == sorted((i % 4, whole(t)) for i, t in enumerate([*texts, texts[0]]))


def test_stitch_without_a_common_boundary_is_one_piece():
    rows = [(0, 0, [0], [12]), (1, 10, [10, 15], [21]), (2, 20, [21, 24], [])]
    assert bpe.stitch(rows) == [(0, 0, 0, 10), (1, 0, 10, 20), (2, 0, 20, -1)]


def test_empty_table(none):
    assert bpe_queries.digests(none).collect() == []


def test_a_contraction_cut_by_a_chunk_is_no_boundary(spark):
    # two chunks out of step until the cut: "'l" of "'ll" at the first one's end must not be trusted
    texts = ["x" * k + "'ll'll'll'll'll'll'll" * 12 for k in range(6)] + ["a'" * k + "re've'll" * 40 for k in range(4)]
    for chunk, overlap in [(24, 5), (25, 4), (26, 6), (9, 3)]:
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = sorted((r.doc_id, bytes(r.ids)) for r in bpe.encode_documents(df, PATH, PATTERN, chunk_chars=chunk, overlap=overlap).collect())
        assert got == [(i, whole(t)) for i, t in enumerate(texts)]
