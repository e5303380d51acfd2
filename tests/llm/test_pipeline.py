import hashlib

import corpus_pipeline
from pyspark.sql import functions as F

from tessera.llm.catalog import oracle_sql, queries
from tests.conftest import SF_SMALL


def test_stages_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        given = docs.count()
        made = stage(spark, docs, SF_SMALL).persist()
        if name != "byte_bpe":
            assert made.columns == columns
        if name in ("toxicity", "near_copies"):
            assert 0.7 * given <= made.count() <= given
        if name == "repeated_strings":
            assert made.count() == given
            assert made.filter(F.length("text") != F.col("n_chars")).count() == 0
        before, docs = docs, made
    texts = sorted((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in before.select("doc_id", "text").collect())
    assert texts == sorted((r.doc_id, r.decoded_sha256) for r in docs.collect())


def test_stages_on_odd_and_empty_tables(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SF_SMALL)
            assert name == "byte_bpe" or made.columns == docs.columns
            assert made.count() <= 3 * docs.count()


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in queries()) == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())


def test_columns_of_clashing_names(spark):
    """Columns named like those that the operators add come through untouched, or are replaced as documented."""
    from tessera.llm import langid, mixing, ngram_join, quality, suffix_dedup, toxicity
    extra = ["key", "size", "draws", "all_draws", "units", "rank", "margin", "rawPrediction", "features", "ck", "bands", "order", "start", "z", "gone",
             "words", "hash", "label", "block", "range", "chunk", "ids"]
    docs = spark.createDataFrame([(i, f"some words of text number {i} and a few more words", "en", "s", i, *[f"v{i}"] * len(extra)) for i in range(6)],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra))
    kept = lambda df: {tuple(r[c] for c in extra) for r in df.collect()}
    want = {tuple([f"v{i}"] * len(extra)) for i in range(6)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert kept(stage(spark, docs, SF_SMALL)) == want, name
    assert kept(langid.predict(docs, None)) == want and kept(toxicity.score(docs, toxicity.Model({}, None, None))) == want
    assert kept(suffix_dedup.clean(docs)) == want and kept(mixing.mix(docs, [1])) == want
    assert kept(ngram_join.one_of_each(docs)) == want
    doubled = docs.withColumns({"n_words": F.lit("x"), "kept": F.lit("x"), "n_bytes": F.lit("x"), "shard": F.lit("x")})
    assert {r.kept for r in quality.judge(doubled).collect()} <= {True, False}
    assert {r.n_bytes for r in suffix_dedup.clean(doubled).collect()} == {len("some words of text number 0 and a few more words")}
    assert {r.shard for r in mixing.mix(doubled, [1]).collect()} == {0}
