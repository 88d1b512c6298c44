import os

import pytest

from listing_analytics import schemas
from listing_analytics.rules.site_n import site_n
from listing_analytics.streaming import ingest
from test_pages import N_PRODUCT, N_VENDOR


def deliver(spark, path, name, rows):
    spark.createDataFrame(rows, schemas.PAGE).coalesce(1).write.parquet(os.path.join(path, name))


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_pages_once_across_restarts(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    start = lambda visited=None: run(ingest.ingest_pages(spark, src, out, state, visited, files_per_batch=1))
    deliver(spark, src, "1", [(1, "u1", "x"), (2, "u2", "x")])
    start()
    deliver(spark, src, "2", [(2, "u2", "x"), (3, "u3", "x"), (3, "u3", "x")])
    start()
    start()
    assert sorted(r.url for r in ingest.read_ingested(spark, out, "pages").collect()) == ["u1", "u2", "u3"]


def test_pages_visited_before_the_stream(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    deliver(spark, src, "1", [(1, "u1", "x"), (2, "u2", "x")])
    from pyspark.sql import functions as F
    visited = spark.createDataFrame([("u1",)], "u string").select(F.md5("u").alias("url_hash"))
    run(ingest.ingest_pages(spark, src, out, state, visited))
    assert [r.url for r in ingest.read_ingested(spark, out, "pages").collect()] == ["u2"]


def test_replay_after_a_failure_before_the_commit(spark, tmp_path, monkeypatch):
    """The batch was written in part, then the job died: its replay must not duplicate a record."""
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    deliver(spark, src, "1", [(1, "u1", N_PRODUCT), (2, "u2", N_VENDOR), (3, "u3", "plain")])
    real, calls = ingest.split_records, []

    def dying(extracted, key):
        tables = real(extracted, key)
        if not calls:
            calls.append(1)
            tables["product"].write.parquet(ingest._batch_path(out, "product", 0))
            raise RuntimeError("executor and driver are gone")
        return tables

    monkeypatch.setattr(ingest, "split_records", dying)
    start = lambda: ingest.ingest_records(spark, src, site_n(), out, state)
    with pytest.raises(Exception, match="gone"):
        start().awaitTermination()
    run(start())
    run(start())
    n = {t: ingest.read_ingested(spark, out, t).count() for t in ("product", "vendor", "review", "processed", "rejects")}
    assert n == {"product": 1, "vendor": 1, "review": 2, "processed": 3, "rejects": 0}


def test_pages_are_stored_only_where_they_are_delivered(spark, sf_dir, monkeypatch):
    """I2 neither moves nor stores whole pages to find equal ones; pages that lack something that they show are one null page."""
    from listing_analytics.plans import roles, source_queries
    kept, store, delivered = [], source_queries.store, source_queries._arrivals
    monkeypatch.setattr(source_queries, "store", lambda df, name: kept.append(df) or store(df, name))
    monkeypatch.setattr(source_queries, "_arrivals", lambda rows, path: kept.append(delivered(rows, path)) or kept[-1])
    columns = "name string, category string, price_usd double, vendor string, marketplace string, main_business string"
    rows = [("ring", "PROMO", 5.2, "ann", "ASIA", "Digital"), ("ring", "PROMO", 5.7, "ann", "EUROPE", "Digital"),  # show the same
            ("ring", "SMALL", 5.2, "ann", "ASIA", "Physical"), ("ring", "SMALL", 5.2, "ann", "EUROPE", "Physical"),
            ("ring", "ECONOMY", 5.2, "bob", "ASIA", "Other"), ("bolt", None, None, "bob", None, "Other"),  # show the same
            ("bolt", None, 5.2, "ann", "ASIA", "Digital"), ("bolt", "SMALL", None, "ann", "ASIA", "Physical")]  # null pages
    monkeypatch.setattr(roles, "listing", lambda spark, sf: spark.createDataFrame(rows, columns))
    found = source_queries.i2(spark, sf_dir).collect()
    made, path = kept
    assert "html" not in made.columns and made.count() == 5
    assert all(name.endswith(".zstd.parquet") for name in os.listdir(os.path.join(path, "delivery-3")) if name.startswith("part-"))
    assert sorted(r.output for r in found) == ["processed"] * 3 + ["product"] + ["rejects"] * 2 + ["review"] * 4 + ["vendor"] * 2
