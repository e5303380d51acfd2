"""Query of byte-level BPE encoding and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe
from tessera.llm.common import read

VOCABULARY = "byte_bpe_50k.tiktoken"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text of ``docs``."""
    import public_tokenizers

    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    encoded = bpe.encode_documents(docs.select("doc_id", "text"), path, pattern)
    back = bpe.decode_documents(encoded, path, pattern)
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op5_byte_bpe": op5_byte_bpe}
