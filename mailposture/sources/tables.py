"""Typed tables, gold partitions and exports."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from mailposture.operators.views import assert_public


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in the order and types of the schema; missing ones are NULL, unknown ones an error."""
    if unknown := sorted(set(df.columns) - set(schema.names)):
        raise ValueError(f"unknown columns: {unknown}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def stable_sort(df: DataFrame, keys: list[str]) -> DataFrame:
    """A total order with NULLs last."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def write_table(df: DataFrame, path: str, schema: StructType, sort_keys: list[str], partition_by: list[str] | None = None) -> None:
    """Overwrite a table with pinned types, sorted by range over all files, zstd-compressed."""
    writer = stable_sort(conform(df, schema), sort_keys).write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """A table, or None if it was never written; columns that came later are NULL in older files."""
    try:
        return spark.read.schema(schema).parquet(path)
    except (AnalysisException, Py4JJavaError) as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON Lines."""
    df.write.mode("overwrite").json(path)


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All months of a gold table; columns that started later are NULL before."""
    return spark.read.option("mergeSchema", True).option("basePath", root).parquet(f"{root}/month=*/{name}")


def flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for CSV."""
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, ArrayType | MapType | StructType) else F.col(f.name) for f in df.schema.fields])


def export_public(df: DataFrame, folder: str, sort_keys: list[str], formats: tuple[str, ...] = ("json", "csv")) -> None:
    """Publish a table as JSON and CSV; the column gate (``views.assert_public``) goes first."""
    rows = stable_sort(assert_public(df), sort_keys)
    if "json" in formats:
        rows.write.mode("overwrite").json(f"{folder}/json")
    if "csv" in formats:
        flat(rows).write.mode("overwrite").option("header", True).csv(f"{folder}/csv")


def upsert_population(existing: DataFrame | None, new: DataFrame, key: str = "population_id") -> DataFrame:
    """The month's table with this run's populations replaced and the others kept; write it to a new folder."""
    if existing is None:
        return new
    return existing.join(new.select(key).distinct(), key, "left_anti").select(existing.columns).unionByName(new, allowMissingColumns=True)


def refresh_extract(old: DataFrame, documents: DataFrame, key: str, document: str, version: str, current: str) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, documents to read again): an extract is read again if its document or the reader changed."""
    same = old.filter(F.col(version) == current).select(key, document).distinct()
    again = documents.join(same, [key, document], "left_anti")
    return old.filter(F.col(version) == current).join(documents.select(key, document).distinct(), [key, document], "left_semi"), again
