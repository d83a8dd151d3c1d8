"""Every registered query's plan is made quickly, whatever the number of rules."""

import time

import pytest

from quorum.queries import QUERIES

#: Queries whose call writes tables first; their plans are measured after that.
LIMIT_SECONDS = 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_optimised_in_time(spark, sf, name):
    df = QUERIES[name](spark, sf)
    begun = time.time()
    df._jdf.queryExecution().optimizedPlan()
    assert time.time() - begun < LIMIT_SECONDS
