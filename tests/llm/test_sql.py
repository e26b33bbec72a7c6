import pytest

from compare import compare, open_duckdb
from tests.llm.conftest import SMALL
from tillwork.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_equals_its_sql(spark, documents, name):
    assert not compare(spark, open_duckdb(SMALL), QUERIES[name], SMALL)


def test_every_kind_of_damage_is_in_the_replica(spark, documents):
    folder = SMALL.replace("0.001", "0.01")
    query = QUERIES["op1_fixity"]
    assert not compare(spark, open_duckdb(folder), query, folder)
    assert {r.state for r in query(spark, folder).collect()} == {"altered", "missing", "extra"}


def test_records_cut_lost_and_added_over_many_files(spark, tmp_path):
    rows = [(i if i != 700 else None, f"http://x/{i}", None if i % 9 == 4 else f"é{i}" * (i % 40)) for i in range(1, 1700)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    db = open_duckdb(f"{tmp_path}/none")
    db.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert not compare(spark, db, QUERIES["op1_fixity"], str(tmp_path))
