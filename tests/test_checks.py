"""Quality rules count failing rows; warn severity is reported, not fatal."""

from ledgerline.operators.checks import Rule, failed, run_checks


def test_rules(spark):
    t = spark.createDataFrame(
        [("a", 1, "x1"), ("a", 2, None), (None, -1, "x3"), ("b", 7, "bad!")],
        "k string, v int, code string")
    parent = spark.createDataFrame([("a",)], "k string")
    rules = [Rule("t", "not_null", ("k",)), Rule("t", "unique", ("k",)),
             Rule("t", "between", ("v",), {"min_value": 0}),
             Rule("t", "regex", ("code",), {"regex": "^[a-z0-9]+$"}),
             Rule("t", "in_set", ("v",), {"values": (1, 2, 7)}),
             Rule("t", "row_count", (), {"max_value": 3}),
             Rule("t", "compound_unique", ("k", "code")),
             Rule("t", "relationship", ("k",), {"to": "p", "field": "k"}, severity="warn")]
    res = {(r.check_name, r.column_name): r.failures
           for r in run_checks({"t": t, "p": parent}, rules).collect()}
    assert res == {("not_null", "k"): 1, ("unique", "k"): 1, ("between", "v"): 1,
                   ("regex", "code"): 1, ("in_set", "v"): 1, ("row_count", ""): 1,
                   ("compound_unique", "k,code"): 0, ("relationship", "k"): 1}
    assert failed(run_checks({"t": t, "p": parent}, rules)).count() == 6
