"""Listings, mappings and registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mailposture.functions.names import fold_name
from mailposture.functions.records import filled, strip


def read_code_list(spark: SparkSession, path: str, columns: list[str], charset: str = "windows-31j", skip: int = 2) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of code lists in a Japanese charset, columns by position below ``skip`` header rows.

    Files are decoded as a whole (code lists are a few megabytes), then split into lines, which are rows from then on.
    Lines with too few columns are kept apart. Needs spark.sql.legacy.javaCharsets for charsets other than UTF.
    """
    lines = spark.read.format("binaryFile").load(path).select("path", F.posexplode(F.split(F.decode("content", charset), r"\r?\n")).alias("_i", "line"))
    lines = lines.filter((F.col("_i") >= skip) & (F.trim("line") != ""))
    schema = ", ".join(f"`{c}` string" for c in columns)
    n = F.size(F.split("line", ",", -1))
    parsed = lines.filter(n >= len(columns)).select(F.from_csv("line", schema).alias("r")).select(*[filled(strip(F.col(f"r.{c}"))).alias(c) for c in columns])
    return parsed, lines.filter(n < len(columns)).select("path", "_i", "line")


def read_matrix_json(spark: SparkSession, path: str, columns: list[str], key: str, exchange: str | None = None, exchanges: list[str] | None = None) -> DataFrame:
    """Rows of a JSON document of the form {fields: [...], data: [[...], ...]}; the first row of each key."""
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", "fields array<string>, data array<array<string>>").alias("d"))
    rows = text.select(F.col("d.fields").alias("f"), F.posexplode("d.data").alias("_i", "v"))
    named = rows.select("_i", *[F.get("v", F.array_position("f", c).cast("int") - 1).alias(c) for c in columns])
    if exchange is not None:
        named = named.filter(F.col(exchange).isin(exchanges or []))
    return named.groupBy(key).agg(F.min_by(F.struct(*columns), "_i").alias("r")).select("r.*")


def exchange_counts(rows: DataFrame, exchange: str) -> DataFrame:
    """Rows by exchange."""
    return rows.groupBy(F.coalesce(exchange, F.lit("(none)")).alias("exchange")).agg(F.count("*").alias("rows"))


def fold_bindings(df: DataFrame, key: str, fields: list[str], order: str) -> DataFrame:
    """One row for each key of query bindings: the first value of each field, and which fields had several."""
    firsts = [F.min_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in fields]
    several = F.array_compact(F.array(*[F.when(F.count_distinct(f) > 1, F.lit(f)) for f in fields])).alias("conflicts")
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*firsts, several)


def read_mapping(spark: SparkSession, path: str, key: str, columns: list[str], version: str | None = None) -> DataFrame:
    """A mapping table from CSV with a header: keys trimmed, empty ones out; raises if it mixes versions."""
    rows = spark.read.option("header", True).csv(path)
    if missing := sorted({key, *columns} - set(rows.columns)):
        raise ValueError(f"{path} lacks columns {missing}")
    if version is not None and len(rows.select(version).distinct().limit(2).collect()) > 1:
        raise ValueError(f"{path} mixes versions")
    return rows.select(filled(strip(F.col(key))).alias(key), *[strip(F.col(c)).alias(c) for c in columns]).filter(F.col(key).isNotNull())


#: What each registry must have, which values a column may take, and which columns are dates.
REGISTRIES = {
    "exclusions": (["kind", "value", "reason", "decided_on"], {"kind": ["domain", "entity"]}, ["decided_on"]),
    "optouts": (["kind", "value", "received_on"], {"kind": ["domain", "entity"]}, ["received_on"]),
    "corrections": (["id", "opened_at", "status", "domain"], {"status": ["open", "fixed", "rejected"]}, ["opened_at"]),
    "set_aside": (["registered_domain", "reason", "investigated_on"], {}, ["investigated_on"]),
}


def read_registry(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """(entries, problems) of a hand-kept registry. A missing file or header raises: unreadable is not empty."""
    required, allowed, dates = REGISTRIES[kind]
    header = spark.read.option("header", True).csv(path).columns
    if missing := sorted(set(required) - set(header)):
        raise ValueError(f"{path} lacks columns {missing}")
    rows = spark.read.option("header", True).schema(StructType([StructField(c, StringType()) for c in header])).csv(path)
    checks = [F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(f"{c} is empty")) for c in required if c not in dates]
    checks += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(v), F.concat(F.lit(f"{c} is unknown: "), F.col(c))) for c, v in allowed.items()]
    checks += [F.when(F.col(c).isNotNull() & F.expr(f"try_to_timestamp(`{c}`) IS NULL"), F.concat(F.lit(f"{c} is no date: "), F.col(c))) for c in dates]
    judged = rows.withColumn("_problems", F.array_compact(F.array(*checks)))
    return judged.filter(F.size("_problems") == 0).drop("_problems"), judged.filter(F.size("_problems") > 0).select(*header, F.explode("_problems").alias("problem"))


def read_registry_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A registry of corporate numbers without a header, columns by position."""
    return spark.read.schema(StructType([StructField(c, StringType()) for c in columns])).csv(path)


def name_mismatches(ours: DataFrame, registry: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Rows whose folded name differs from the registry's under the same number."""
    joined = ours.select(key, F.col(a).alias("our_name")).join(registry.select(key, F.col(b).alias("registry_name")), key)
    return joined.filter(fold_name(F.col("our_name")) != fold_name(F.col("registry_name")))
