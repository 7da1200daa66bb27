"""Every query against its SQL, on the smallest data."""

import duckdb
import pytest

from millrace.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, data, duck, tmp_path, name):
    catalogue.QUERIES[name](spark, data).write.parquet(f"{tmp_path}/out")
    duck.execute(f"create or replace table got as select * from '{tmp_path}/out/*.parquet'")
    duck.execute(f"create or replace table want as {catalogue.ORACLES[name]}")
    kinds = lambda t: sorted(r[:2] for r in duck.execute(f"describe {t}").fetchall())
    assert kinds("got") == kinds("want")
    columns = ", ".join(f'"{c}"' for c, _ in kinds("got"))
    for a, b in (("got", "want"), ("want", "got")):
        assert duck.execute(f"select {columns} from {a} except all select {columns} from {b} limit 3").fetchall() == []


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
