"""The registered queries with an oracle, and how the subpackage is registered."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences


@pytest.mark.parametrize("name", ["op3_line_runs", "op8_golomb_dedup"])
def test_oracle(spark, sf_dir, name):
    assert differences(entry.queries()[name](spark, sf_dir), connect(sf_dir), entry.oracle_sql()[name]) is None


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
