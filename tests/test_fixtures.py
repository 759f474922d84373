"""Views that Spark makes by plans of its own: the rows of their SQL, in fewer shuffles."""

import re

import pytest

from chainframe.fixtures import PLANS, VIEWS, Fixtures

SF_DIR = "/root/testdata/sf0.001"


class BySql(Fixtures):
    """Every view by its SQL."""

    def __getattr__(self, name):
        if name not in VIEWS:
            return super().__getattr__(name)
        if name not in self._made:
            self._made[name] = self.spark.sql(VIEWS[name], **{n: getattr(self, n) for n in set(re.findall(r"{(\w+)}", VIEWS[name]))})
        return self._made[name]


@pytest.mark.parametrize("name", [n for n in PLANS if n in VIEWS])
def test_plans_have_the_rows_of_their_sql(spark, name):
    got, want = getattr(Fixtures(spark, SF_DIR), name), getattr(BySql(spark, SF_DIR), name)
    assert got.dtypes == want.dtypes
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_logs_are_shuffled_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = Fixtures(spark, SF_DIR).logs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2  # line items and orders, once each
