"""Every query with SQL gives the rows of its SQL, on the smallest test tables."""

import os

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("CATALOG_SF_DIR", entry.SMOKE_FOLDER)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_its_sql(spark, connection, name):
    assert oracle.difference(entry.queries()[name](spark, FOLDER), connection, entry.oracle_sql()[name]) is None


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns and not df.isEmpty()


def test_streamed_scores_equal_batch_scores(spark):
    batch, stream = (entry.queries()[n](spark, FOLDER) for n in ("score_batch", "stream_score"))
    assert batch.exceptAll(stream).isEmpty() and stream.exceptAll(batch).isEmpty()


def test_skipped_and_scored_rows_are_all_rows(spark):
    scored, skipped = (entry.queries()[n](spark, FOLDER).select("o_orderkey") for n in ("score_batch", "score_skipped"))
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_orderkey")
    assert scored.unionByName(skipped).exceptAll(orders).isEmpty()
    assert scored.count() + skipped.count() == orders.count()
