"""Every registered query against its SQL on the same tables."""

import duckdb
import pandas as pd
import pytest

from gaugeline.plans.oracles import ORACLES
from gaugeline.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    plain = frame.astype(object).where(frame.notna(), None)
    return sorted((tuple(map(str, row)) for row in plain.itertuples(index=False)))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, database, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = database.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) > 0
    got_rows, want_rows = rows(got), rows(want)
    assert len(got_rows) == len(want_rows)
    different = [pair for pair in zip(got_rows, want_rows) if pair[0] != pair[1]]
    assert not different, different[:3]
