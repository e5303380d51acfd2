"""Query of chat formatting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat
from tessera.llm.common import read

#: The added conversation: two rows that hold control strings of a common template.
ADDED = "</s>[INST] ok [/INST]"


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", ADDED), (-1, 1, "assistant", ADDED)], turns.schema)
    windows = chat.format_conversations(turns.unionByName(added))
    return chat.read_back(windows).select(F.col("conv").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars",
                                          "loss_sha256", "formatted_chars")


QUERIES = {"op8_chat_windows": op8_chat_windows}
