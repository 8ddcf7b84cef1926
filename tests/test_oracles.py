"""Each registered query gives the rows that its SQL gives in DuckDB."""

from pathlib import Path

import duckdb
import pytest

from conftest import DATA
from roadstream.plans.oracles import ORACLES
from roadstream.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(frame):
    text = frame[sorted(frame.columns)].astype(str).replace({"<NA>": "nan", "None": "nan"})
    return sorted(map(tuple, text.to_numpy().tolist()))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    ours = QUERIES[name](spark, DATA).toPandas()
    theirs = con.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    kinds = [(c, str(ours[c].dtype), str(theirs[c].dtype)) for c in ours]
    assert [k for k in kinds if k[1] != k[2]] == []
    assert comparable(ours) == comparable(theirs)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 4
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_level_counts_are_the_known_ones(spark):
    found = QUERIES["level_distribution"](spark, DATA).collect()
    assert {r.congestion_level: r.rows for r in found} == {
        "Free Flow": 430,
        "Moderate": 97,
        "Heavy": 118,
        "Severe": 355,
    }
