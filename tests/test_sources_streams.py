"""Round trips of sources and sinks, and streams run to their end."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from mailposture.operators import compare
from mailposture.sources import bronze, listings, tables
from mailposture.streaming import stream


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def raw(domain, data, method_extra=None):
    return json.dumps({"ts": "2026-01-01T00:00:00Z", "domain": domain, "query_name": domain, "query_type": "TXT", "purpose": "spf", "rcode": "NOERROR", "observed": True, "record_present": True, "answers": [{"type": "TXT", "ttl": 60, "data": data}], "dnssec": {"ad": True}})


@pytest.fixture
def root(tmp_path):
    for method, lines in (("a", [raw("x.example", ["v=spf1 ", "-all"]), raw("y.example", "v=spf1 ~all"), '{"domain": "torn'], ), ("b", [raw("x.example", [" lead", "ing"])])):
        folder = tmp_path / f"method={method}"
        folder.mkdir()
        (folder / "part-0000.jsonl").write_text("\n".join(lines))
    return str(tmp_path)


def test_bronze_scan_and_append(spark, root):
    good, broken = bronze.read_bronze(spark, root)
    assert rows(good, "domain", "method") == [("x.example", "a"), ("x.example", "b"), ("y.example", "a")]
    data = {(r.domain, r.method): r.answers[0].data for r in good.collect()}
    assert data["x.example", "a"] == ["v=spf1 ", "-all"] and data["y.example", "a"] == ["v=spf1 ~all"] and data["x.example", "b"] == [" lead", "ing"]
    assert broken.count() == 1
    asked = spark.createDataFrame([("z.example", "z.example", "TXT", "spf", "c", "NOERROR", [["v=spf1", " -all"]], 60), ("z.example", "_dmarc.z.example", "TXT", "dmarc", "c", "SERVFAIL", None, None)], "domain string, query_name string, query_type string, purpose string, method string, rcode string, values array<array<string>>, ttl int")
    out = bronze.to_raw(asked, "2026-01", "tool", "1")
    bronze.append_bronze(out, root)
    bronze.append_bronze(out, root)
    again = bronze.read_bronze(spark, root)[0].filter("method = 'c'")
    assert again.count() == 4
    state = {r.purpose: (r.observed, r.record_present, [a.data for a in r.answers]) for r in again.collect()}
    assert state == {"spf": (True, True, [["v=spf1", " -all"]]), "dmarc": (False, None, [])}


def test_typed_tables(spark, tmp_path):
    schema = StructType([StructField("k", LongType()), StructField("name", StringType()), StructField("tags", ArrayType(StringType())), StructField("n", IntegerType())])
    df = spark.createDataFrame([("b", 2), ("a", None), ("c", 1)], "name string, k long")
    path = str(tmp_path / "t")
    assert tables.read_table(spark, path, schema) is None
    for _ in range(2):  # the same rows in the same order again
        tables.write_table(df, path, schema, ["k", "name"])
        back = tables.read_table(spark, path, schema)
        assert back.schema == schema and [r.name for r in back.coalesce(1).collect()] == ["c", "b", "a"]
    with pytest.raises(ValueError, match="unknown columns"):
        tables.write_table(df.withColumn("x", F.lit(1)), path, schema, ["k"])
    flat = tables.flat(back.withColumn("tags", F.array(F.lit("a"))))
    assert flat.first().tags == '["a"]'
    tables.export_public(spark.createDataFrame([("p", 1, ["x"])], "population_id string, n int, l array<string>"), str(tmp_path / "out"), ["population_id"])
    assert spark.read.option("header", True).csv(str(tmp_path / "out/csv")).first().l == '["x"]'
    with pytest.raises(ValueError, match="identifying"):
        tables.export_public(spark.createDataFrame([("x",)], "domain string"), str(tmp_path / "no"), ["domain"])


def test_gold_months_and_upsert(spark, tmp_path):
    for month, df in (("2026-01", spark.createDataFrame([("p", 1)], "population_id string, a int")), ("2026-02", spark.createDataFrame([("p", 2, 5)], "population_id string, a int, b int"))):
        df.write.parquet(str(tmp_path / f"month={month}/stats"))
    assert rows(tables.read_gold(spark, str(tmp_path), "stats"), "month", "a", "b") == [("2026-01", 1, None), ("2026-02", 2, 5)] or rows(tables.read_gold(spark, str(tmp_path), "stats"), "a", "b") == [(1, None), (2, 5)]
    old = spark.createDataFrame([("p", 1), ("q", 2)], "population_id string, a int")
    merged = tables.upsert_population(old, spark.createDataFrame([("p", 9), ("r", 3)], "population_id string, a int"))
    assert rows(merged, "population_id", "a") == [("p", 9), ("q", 2), ("r", 3)]
    kept, again = tables.refresh_extract(spark.createDataFrame([("e1", "d1", "2"), ("e2", "d2", "1"), ("e3", "d3", "2")], "k string, doc string, v string"), spark.createDataFrame([("e1", "d1"), ("e2", "d2"), ("e3", "d9")], "k string, doc string"), "k", "doc", "v", "2")
    assert rows(kept, "k") == [("e1",)] and rows(again, "k") == [("e2",), ("e3",)]
    tables.write_jsonl(old, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_listings(spark, tmp_path):
    (tmp_path / "codes.csv").write_bytes("題名\nコード,名前,区分\nE1,株式会社甲, 上場 \nE2,乙\nE3,丙,\n".encode("cp932"))
    good, bad = listings.read_code_list(spark, str(tmp_path / "codes.csv"), ["code", "name", "kind"])
    assert rows(good, "code", "name", "kind") == [("E1", "株式会社甲", "上場"), ("E3", "丙", None)] and bad.count() == 1
    (tmp_path / "m.json").write_text(json.dumps({"fields": ["cik", "name", "exchange"], "data": [[1, "A", "NYSE"], [2, "B", "OTC"], [1, "A2", "NYSE"], [3, "C", None]]}))
    matrix = listings.read_matrix_json(spark, str(tmp_path / "m.json"), ["cik", "name", "exchange"], "cik")
    assert rows(matrix, "cik", "name") == [("1", "A"), ("2", "B"), ("3", "C")]
    assert rows(listings.exchange_counts(matrix, "exchange"), "exchange", "rows") == [("(none)", 1), ("NYSE", 1), ("OTC", 1)]
    assert listings.read_matrix_json(spark, str(tmp_path / "m.json"), ["cik", "exchange"], "cik", "exchange", ["OTC"]).count() == 1
    bindings = spark.createDataFrame([("Q1", 1, "a", None), ("Q1", 2, "b", "L"), (None, 3, "x", None)], "qid string, i int, site string, lei string")
    assert rows(listings.fold_bindings(bindings, "qid", ["site", "lei"], "i"), "qid", "site", "lei", "conflicts") == [("Q1", "a", "L", ["site"])]
    (tmp_path / "map.csv").write_text("code,label,version\n 1 ,One,v1\n,none,v1\n2,Two,v1\n")
    assert rows(listings.read_mapping(spark, str(tmp_path / "map.csv"), "code", ["label"], "version"), "code", "label") == [("1", "One"), ("2", "Two")]
    with pytest.raises(ValueError, match="lacks"):
        listings.read_mapping(spark, str(tmp_path / "map.csv"), "code", ["nope"])
    (tmp_path / "map2.csv").write_text("code,label,version\n1,One,v1\n2,Two,v2\n")
    with pytest.raises(ValueError, match="mixes"):
        listings.read_mapping(spark, str(tmp_path / "map2.csv"), "code", ["label"], "version")
    (tmp_path / "ex.csv").write_text("kind,value,reason,decided_on\ndomain,x.example,asked,2026-01-01\ncity,y,asked,2026-01-01\ndomain,,asked,yesterday\n")
    entries, problems = listings.read_registry(spark, str(tmp_path / "ex.csv"), "exclusions")
    assert entries.count() == 1 and {r.problem for r in problems.collect()} == {"kind is unknown: city", "value is empty", "decided_on is no date: yesterday"}
    with pytest.raises(ValueError, match="lacks"):
        listings.read_registry(spark, str(tmp_path / "map.csv"), "exclusions")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        listings.read_registry(spark, str(tmp_path / "missing.csv"), "exclusions")
    (tmp_path / "numbers.csv").write_text("1,株式会社甲\n2,乙\n")
    registry = listings.read_registry_csv(spark, str(tmp_path / "numbers.csv"), ["number", "title"])
    ours = spark.createDataFrame([("1", "甲 株式会社"), ("2", "丙")], "number string, name string")
    assert rows(listings.name_mismatches(ours, registry, "number", "name", "title"), "number") == [("2",)]


def test_run_metrics_and_phases(spark):
    outcome = spark.createDataFrame([(i, "failed" if i % 3 == 0 else "success", "R" if i % 3 == 0 else None, "W" if i > 2 else None) for i in range(12)], "key int, outcome string, reason string, warning string")
    row = compare.run_metrics(outcome, "p5").first()
    assert (row.input, row.success, row.failed, row.status) == (12, 8, 4, "partial") and row.warnings[0].examples == [3, 4, 5, 6, 7]
    runs = compare.run_table(spark.createDataFrame([("a", "success", 5, 4), ("c", "success", 3, 3)], "phase string, status string, input long, success long"), ["a", "b", "c"])
    assert rows(runs, "phase", "status") == [("a", "success"), ("b", "not_run"), ("c", "success")]
    assert rows(compare.phase_flow(runs), "phase", "gap") == [("a", None), ("c", 1)]
    checks = compare.acceptance(outcome, {"n": (F.count("*"), 1, 20), "bad": (F.avg(F.lit(2.0)), None, 1.0)})
    assert rows(checks, "check", "passed") == [("bad", False), ("n", True)]


def test_ingest_reads_each_part_once(spark, root, tmp_path):
    out, mark = str(tmp_path / "silver"), str(tmp_path / "mark")
    for _ in range(2):
        stream.ingest(stream.stream_bronze(spark, root).filter("domain is not null"), out, mark).awaitTermination()
        assert spark.read.parquet(out).filter("domain like '%.example'").count() == 3
    (tmp_path / "method=a" / "part-0001.jsonl").write_text(raw("new.example", ["x"]))
    stream.ingest(stream.stream_bronze(spark, root).filter("domain is not null"), out, mark).awaitTermination()
    assert spark.read.parquet(out).filter("domain like '%.example'").count() == 4


def test_health_and_dedupe_streams(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2026, 1, 1, h, m)
    rows_in = [("a", "spf", "NOERROR", True, at(1)), ("a", "spf", "NOERROR", True, at(1, 5)), ("b", "spf", "SERVFAIL", False, at(1, 10)), ("c", "mx", "NOERROR", True, at(9))]
    spark.createDataFrame(rows_in, "domain string, purpose string, rcode string, observed boolean, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema("domain string, purpose string, rcode string, observed boolean, ts timestamp").parquet(str(tmp_path / "in"))
    stream.run_once(stream.dedupe_stream(source(), ["domain", "purpose"]), "deduped")
    assert spark.table("deduped").count() == 3
    stream.run_once(stream.health_stream(source()), "health", "complete")
    assert rows(spark.table("health"), "purpose", "rcode", "answers", "unobserved") == [("mx", "NOERROR", 1, 0), ("spf", "NOERROR", 2, 0), ("spf", "SERVFAIL", 1, 1)]


def test_streak_stream(spark, tmp_path):
    months = spark.createDataFrame([("d", 1, False), ("d", 2, False), ("d", 2, False), ("d", 3, False), ("e", 1, False), ("e", 2, True), ("e", 3, False)], "domain string, month int, corroborated boolean")
    months.coalesce(1).write.parquet(str(tmp_path / "m"))
    source = spark.readStream.schema("domain string, month int, corroborated boolean").parquet(str(tmp_path / "m"))
    stream.run_once(stream.stale_streak_stream(source, ["domain"]), "streaks", "append")
    assert rows(spark.table("streaks"), "domain", "month", "streak", "is_stale") == [("d", 1, 1, False), ("d", 2, 2, False), ("d", 3, 3, True), ("e", 1, 1, False), ("e", 2, 0, False), ("e", 3, 1, False)]
