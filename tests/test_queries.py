"""Every registered core query against its SQL, on the smallest tables."""

import pytest

from mailposture.operators import population
from mailposture.plans import more_queries, more_sql, queries, sql, table_queries, table_sql  # noqa: F401
from tests.oracle import duck_rows, spark_rows


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_query(spark, small, name):
    got = spark_rows(queries.REGISTRY[name](spark, small))
    if name in sql.ORACLE:
        assert got == duck_rows(sql.ORACLE[name], small)
    else:
        assert got[1]
        assert got == spark_rows(queries.REGISTRY[name](spark, small))  # the same on every run


@pytest.mark.parametrize("name", ["enrichment_counts", "ordered_enrichment"])
def test_enrichment_meets_one_supplier_each(spark, tmp_path, monkeypatch, name):
    """Customers of one nation do not meet all its suppliers, only the least; found is what each step looks up."""
    spark.range(300).selectExpr("id AS c_custkey", "1 AS c_nationkey").write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(5, 55).selectExpr("id AS s_suppkey", "1 AS s_nationkey").write.parquet(str(tmp_path / "supplier.parquet"))
    found, enrich = {}, population.enrich

    def seen(df, key, column, steps):
        found.update({n: step(df.filter(f"{column} IS NULL")).collect() for n, step in steps})
        return enrich(df, key, column, steps)

    monkeypatch.setattr(population, "enrich", seen)
    got = queries.REGISTRY[name](spark, str(tmp_path)).collect()
    assert [len(found[n]) for n in ("nation", "key")] == [80, 20]
    assert {r.site for r in found["nation"]} == {"s000000005"}
    assert sum(r["rows"] if "rows" in r else 1 for r in got) == 300


def test_entry(spark, small):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(sql.ORACLE) <= set(__spark_entry__.queries())
    assert set(sql.ORACLE) <= set(__spark_entry__.oracle_sql())


def test_core_does_not_import_llm():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "mailposture"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "mailposture.llm" not in path.read_text(), path
