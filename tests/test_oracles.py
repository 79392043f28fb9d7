"""Every registered query against its SQL oracle."""

import os

import pytest
from compare import connect, duck_rows, spark_rows

from cadence.workload.oracles import ORACLES
from cadence.workload.registered import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    got_cols, got = spark_rows(QUERIES[name](spark, SF_DIR))
    want_cols, want = duck_rows(con, ORACLES[name])
    assert got_cols == want_cols
    assert got == want
