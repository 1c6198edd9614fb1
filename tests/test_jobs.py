import pytest
from pyspark.sql import functions as F

from tierworks import jobs
from tierworks.operators import landing
from tierworks.operators.landing import land_bronze, read_latest
from tierworks.sources.catalog import read_table


def test_seed_to_gold(spark, tmp_path):
    raw, bronze, silver, gold = (str(tmp_path / n) for n in ("raw", "bronze", "silver", "gold"))
    jobs.seed(spark, raw, rows=40, days=0, number=1)
    land_bronze(spark, raw, bronze)
    jobs.silver(spark, bronze, silver, F.lit("2024-01-01").cast("timestamp"))
    jobs.seed(spark, raw, rows=40, days=0, number=2)
    landed = land_bronze(spark, raw, bronze)
    assert landed.count() == 12 and landed.filter("rows <> 80").count() == 0
    jobs.silver(spark, bronze, silver, F.lit("2024-02-01").cast("timestamp"))

    dim = read_latest(spark, f"{silver}/dim_customer")
    snapshot = read_latest(spark, f"{silver}/dim_customer_scd2")
    assert dim.filter("is_current").count() == 40 and dim.count() > 40
    names = ["id", "segment", "region", "effective_from", "effective_to"]
    as_plain = snapshot.withColumnsRenamed({"dbt_valid_from": "effective_from", "dbt_valid_to": "effective_to"})
    assert sorted(map(repr, as_plain.select(names).collect())) == sorted(map(repr, dim.select(names).collect()))

    mart = jobs.gold(spark, bronze, silver, gold).collect()
    total = read_table(spark, f"{silver}/billing_invoices").agg(F.sum("amount")).first()[0]
    assert abs(sum(r["revenue"] for r in mart) - total) < 1e-6
    assert sorted(r["revenue_rank"] for r in mart)[0] == 1
    assert read_table(spark, f"{silver}/_rejected/crm_customers").count() == 0


def test_stream_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"event_id": "a", "customer_id": 3, "amount": 1.5, "ts": "t"}\nbroken\n')
    queries = jobs.stream(
        spark, str(tmp_path / "bronze"), str(tmp_path / "log"), "files", path=str(tmp_path / "in"), available_now=True
    )
    for query in queries:
        query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "bronze" / "orders")).collect() == [("a", "3", 1.5, "t")]
    bad = spark.read.parquet(str(tmp_path / "bronze" / "_dead_letters" / "orders"))
    assert bad.collect() == [("broken",)]


def lost(df):
    """``df`` with a row on which its reader fails."""
    return df.withColumn(df.columns[0], F.raise_error(F.lit("lost")).cast(df.schema[0].dataType))


def counts(spark, *places):
    return [read_table(spark, p).count() for p in places]


@pytest.fixture
def lake(spark, tmp_path):
    raw, bronze, silver, gold = (str(tmp_path / n) for n in ("raw", "bronze", "silver", "gold"))
    jobs.seed(spark, raw, rows=10, days=0, number=1)
    land_bronze(spark, raw, bronze)
    jobs.silver(spark, bronze, silver, F.lit("2024-01-01").cast("timestamp"))
    jobs.gold(spark, bronze, silver, gold)
    return raw, bronze, silver, gold


def test_a_failed_landing_leaves_bronze(spark, lake, monkeypatch):
    raw, bronze, _, _ = lake
    before = counts(spark, f"{bronze}/crm_customers")
    jobs.seed(spark, raw, rows=10, days=0, number=2)
    read = landing.read_source
    monkeypatch.setattr(landing, "read_source", lambda *a: lost(read(*a)))
    with pytest.raises(Exception, match="lost"):
        land_bronze(spark, raw, bronze)
    assert counts(spark, f"{bronze}/crm_customers") == before


def test_a_failed_silver_and_gold_leave_their_tables(spark, lake, monkeypatch):
    _, bronze, silver, gold = lake
    places = [f"{silver}/billing_invoices", f"{silver}/hr_employees", f"{gold}/revenue_by_segment"]
    before = counts(spark, *places)
    conform, revenue = jobs.conform, jobs.revenue_by
    monkeypatch.setattr(jobs, "conform", lambda df, types, **o: (lost(conform(df, types, **o)[0]) if "emp_id" in types else conform(df, types, **o)[0], conform(df, types, **o)[1]))
    with pytest.raises(Exception, match="lost"):
        jobs.silver(spark, bronze, silver, F.lit("2024-02-01").cast("timestamp"))
    monkeypatch.setattr(jobs, "revenue_by", lambda *a: revenue(*a).withColumn("revenue", F.raise_error(F.lit("lost")).cast("double")))
    with pytest.raises(Exception, match="lost"):
        jobs.gold(spark, bronze, silver, gold)
    assert counts(spark, *places) == before
