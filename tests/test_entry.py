import os

import __spark_entry__ as E
from starload.registry.spark_queries import REGISTRY


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"date_id", "country", "lines", "quantity", "revenue"}
    assert df.count() > 0


def test_registry_and_oracle_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(REGISTRY) <= set(o)


def test_stream_ingest_rows(spark):
    df = E.queries()["stream_ingest"](spark, "/root/testdata/sf0.001")
    assert df.count() == 1000 and df.select("session_id").distinct().count() == 1000
    assert os.path.exists("/root/testdata/sf0.001/events.parquet")
