"""Query of embedding whitening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import whitening
from tessera.llm.common import read


def components(vectors: DataFrame) -> DataFrame:
    """One row for each usable vector and component."""
    model = whitening.fit(vectors)
    error = whitening.identity_error(vectors, model)
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    rows = whitening.transform(vectors.select("vec_id", "embedding"), model)
    rows = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(explained, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES = {"op11_whitening": op11_whitening}
