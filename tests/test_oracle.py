"""Every registered query with an oracle matches DuckDB on the smallest driver tables."""
import pytest

import __spark_entry__ as entry
from latticeguard.plans.check import compare, duck_connect

SF = "/root/testdata/sf0.001"
TARGETED = {"model_quality", "expert_evaluation"}
SF_TARGETS = "/root/testdata/sf0.01"
#: 20 fits: compared at sf0.01 by check_oracle.py; tests/test_training_cv.py tests the operator.
SLOW = {"cv_results"}
NAMES = sorted(set(entry.oracle_sql()) - SLOW)


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sf, con = (SF_TARGETS, duck_connect(SF_TARGETS)) if name in TARGETED else (SF, con)
    res = compare(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name])
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res["first_mismatches"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert sorted(df.columns) == ["mean_score", "n_assets", "priority"] and len(rows) > 0
