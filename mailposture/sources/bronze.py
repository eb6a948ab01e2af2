"""Raw answers: scan, append, projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailposture.functions.records import answer_state

#: Schema of a raw answer; ``data`` is read as text, since it holds a string or an array of strings.
RAW = (
    "schema_version string, run_id string, ts timestamp, domain string, query_name string, query_type string, purpose string, resolver string, "
    "protocol string, rcode string, observed boolean, record_present boolean, answers array<struct<type:string,ttl:int,data:string>>, "
    "cname_chain array<string>, authorities array<map<string,string>>, additionals array<map<string,string>>, authoritative_ns string, "
    "dnssec struct<do:boolean,ad:boolean,rrsig_present:boolean>, retries int, duration_ms int, tool string, tool_version string, error string"
)
#: Rows of one part file at most.
ROWS_PER_FILE = 500_000


def typed_answers(df: DataFrame) -> DataFrame:
    """``data`` of each answer as an array of character strings, whichever form it came in."""
    chunks = lambda d: F.when(d.startswith("["), F.from_json(d, "array<string>")).otherwise(F.array(d))
    return df.withColumn("answers", F.transform("answers", lambda a: F.struct(a["type"].alias("type"), a["ttl"].alias("ttl"), chunks(a["data"]).alias("data"))))


def read_bronze(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(answers, broken lines) of a folder of JSON Lines parts by method, compressed ones included.

    Lines that cannot be read (the torn end of a part, say) are kept apart so that they can be counted; the method
    comes from the folder name.
    """
    rows = spark.read.schema(f"{RAW}, _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("basePath", root).json(f"{root}/method=*")
    # The reader wants another column beside the corrupt text to be read as well.
    torn = F.col("_corrupt_record").isNotNull() & (F.coalesce(F.length("domain"), F.lit(0)) >= 0)
    good = rows.filter(~torn).drop("_corrupt_record")
    return typed_answers(good), rows.filter(torn).select(F.input_file_name().alias("file"), F.col("_corrupt_record").alias("line"), "domain")


def append_bronze(df: DataFrame, root: str) -> None:
    """Add new parts by method; existing parts are never touched."""
    df.write.mode("append").partitionBy("method").option("maxRecordsPerFile", ROWS_PER_FILE).option("compression", "gzip").json(root)


def to_raw(df: DataFrame, run_id: str, tool: str, version: str) -> DataFrame:
    """S3: answers (domain, query_name, query_type, purpose, method, rcode, values array<array<string>>, ttl, ...) as raw rows.

    TXT strings stay apart as they came. Whether a record is there is NULL where the question failed.
    """
    answers = F.transform(F.coalesce("values", F.array().cast("array<array<string>>")), lambda v: F.struct(F.col("query_type").alias("type"), F.col("ttl").cast("int").alias("ttl"), v.alias("data")))
    state = answer_state(F.col("rcode"), answers)
    fixed = {"schema_version": F.lit("1"), "run_id": F.lit(run_id), "tool": F.lit(tool), "tool_version": F.lit(version)}
    rows = df.withColumns({**fixed, "answers": answers, "observed": state["observed"], "record_present": state["record_present"]})
    names = [f.split()[0] for f in RAW.split(", ")]
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in names], "method")
