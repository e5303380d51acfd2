"""Readers and writers.

* ``read_table`` - parquet scan of one driver table, with column pruning so
  the scan's ``ReadSchema`` holds only what the query uses.
* ``read_csv_sources`` - the reference's raw inputs: several CSV files with
  declared schemas (codes as strings), each optional; missing ones are
  skipped, and no source at all is an error.
* ``write_splits`` / ``read_split`` - the prepared table partitioned by split,
  so reading one split prunes the others at the file level.
* ``to_json_report`` - nested JSON (map feature -> struct) of a long table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def _exists(spark: SparkSession, path: str) -> bool:
    """Path check through Hadoop's FileSystem (works for any cluster file system)."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(p))
    except Exception:  # noqa: BLE001 - e.g. a Connect session without a JVM handle
        return os.path.exists(path)


def read_csv_sources(spark: SparkSession, sources: dict[str, tuple[str, T.StructType | str]],
                     header: bool = True) -> dict[str, DataFrame]:
    """Read each ``name -> (path, schema)`` that exists; raise if none does.

    With a header the declared columns are found by name, in whatever order the file has them;
    columns that are not declared are left out, declared ones that the file lacks are null.
    """
    found = {}
    for name, (path, schema) in sources.items():
        if _exists(spark, path):
            declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
            found[name] = _read_csv(spark, path, declared, header)
    if not found:
        raise FileNotFoundError("no source file found: " + ", ".join(p for p, _ in sources.values()))
    return found


def _read_csv(spark: SparkSession, path: str, declared: T.StructType, header: bool) -> DataFrame:
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if not header:
        return reader.schema(declared).csv(path)
    types = {f.name: f.dataType for f in declared.fields}
    names = reader.csv(path).columns  # reads the first line
    in_file = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    df = reader.schema(in_file).csv(path)
    return df.select(*[F.col(f"`{n}`") if n in names else F.lit(None).cast(t).alias(n) for n, t in types.items()])


def write_splits(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite",
                 fmt: str = "parquet") -> None:
    """One write of all splits, partitioned by the split column."""
    df.write.mode(mode).partitionBy(split_col).format(fmt).option("header", True).save(path)


def read_split(spark: SparkSession, path: str, split: str | None = None, split_col: str = "split",
               fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is not None:
            reader = reader.schema(schema)
    df = reader.load(path)
    return df if split is None else df.where(F.col(split_col) == F.lit(split))


def to_json_report(long_df: DataFrame, group_cols: list[str], key_col: str,
                   value_cols: list[str], map_name: str = "feature_results") -> DataFrame:
    """One JSON document per group: group columns plus ``{key: {values...}}``.

    The map is built per group by a grouped aggregate; a group is one batch of
    a report (its size is the number of features), never a whole table.
    """
    agg = nested_report(long_df, group_cols, key_col, value_cols, map_name)
    return agg.select(*group_cols, F.to_json(F.struct(*group_cols, map_name)).alias("json"))


def write_report(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """A report as JSON lines (nested columns stay nested, nulls are written) or as CSV with a header (flat columns)."""
    if fmt == "csv":
        df.write.mode(mode).option("header", True).csv(path)
    elif fmt == "json":
        df.write.mode(mode).option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"reports are json or csv, not {fmt}")


def read_report(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """A report read back with its declared schema; a malformed line is an error."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return reader.json(path) if fmt == "json" else reader.option("header", True).option("enforceSchema", False).csv(path)


def nested_report(long_df: DataFrame, group_cols: list[str], key_col: str, value_cols: list[str], map_name: str = "feature_results") -> DataFrame:
    """One row per group with ``{key: {values...}}`` as a map column (see ``to_json_report``)."""
    entries = F.sort_array(F.collect_list(F.struct(F.col(key_col).cast("string").alias("key"), F.struct(*value_cols).alias("value"))))
    return long_df.groupBy(*group_cols).agg(F.map_from_entries(entries).alias(map_name))
