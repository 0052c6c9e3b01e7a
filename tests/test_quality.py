import pytest

from lakeshore.operators.quality import Suite, max_between, not_null, pair_greater, run_suite


def test_not_null_rule(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    r = run_suite(df, Suite("s", [not_null("a")]), "r1").first()
    assert (r.total, r.failed, r.not_evaluated, r.success) == (3, 1, 0, False)


def test_pair_rule_three_states(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (3, 1)], "a int, b int")
    r = run_suite(df, Suite("s", [pair_greater("a", "b")]), "r1").first()
    assert (r.total, r.failed, r.not_evaluated, r.success) == (3, 1, 1, False)


def test_pair_rule_across_types_is_not_evaluated(spark):
    df = spark.createDataFrame([("7f1c-uuid", 2), ("10", 2)], "order_id string, product_id bigint")
    r = run_suite(df, Suite("s", [pair_greater("order_id", "product_id")]), "r1").first()
    assert (r.failed, r.not_evaluated) == (0, 1)


def test_suite_one_pass_and_fail_on_error(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0)], "a int, p double")
    s = Suite("s", [not_null("a"), max_between("p", 0, 10), pair_greater("p", "a", or_equal=True)])
    out = run_suite(df, s, "r1").orderBy("rule_index").collect()
    assert [o.success for o in out] == [True, True, True]
    # one scan: a single aggregate in the plan
    plan = run_suite(df, s, "r1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") <= 2
    with pytest.raises(AssertionError):
        run_suite(df, Suite("s", [max_between("p", 0, 6)]), "r1", fail_on_error=True)
