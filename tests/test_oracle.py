"""Every registered query against its SQL on the same files."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as driver
from oracle.queries import ORACLE
from storeloom.catalog import QUERIES
from storeloom.sources.retail import bronze
from tests.conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _sorted(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in found]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)) if v is None else "", str(v))
                                             for v in r))


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_matches_sql(spark, con, name):
    df = driver.queries()[name](spark, SMALL)
    cursor = con.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(df.collect(), df.columns) == _sorted(cursor.fetchall(), columns)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_every_document_is_reached(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    texts = bronze(spark, SMALL, "order_reviews")["order_reviews"].select("review_comment_message").distinct()
    assert texts.count() > 0.9 * docs


def test_entry(spark):
    assert driver.entry(spark).count() > 0
