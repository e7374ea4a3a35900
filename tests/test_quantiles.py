"""Exact quantiles by sketched brackets, against numpy."""

import numpy as np
import pytest

from tunetrail.operators import explore as ex
from tunetrail.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0)


def _frame(spark, **cols):
    return spark.createDataFrame(list(zip(*[[None if v is None else float(v) for v in x] for x in cols.values()])), ", ".join(f"{c} double" for c in cols)).repartition(5)


@pytest.mark.parametrize("margin", [0.002, 0.0])
def test_equal_to_numpy_in_small_brackets(spark, margin):
    r = np.random.default_rng(3)
    n = 30_000
    cols = {"even": r.uniform(-1, 1, n), "long_tail": np.exp(4 * r.normal(size=n)), "few": r.integers(0, 3, n),
            "third": np.where(r.random(n) < 1 / 3, 0.5, r.normal(size=n)), "same": np.full(n, 7.0), "wide": r.choice([-1e300, -1.0, 0.0, 1e-300, 1e300], n)}
    rounds = []
    got = exact_quantiles(_frame(spark, **cols), list(cols), PROBS, limit=100, margin=margin, rounds=rounds)
    for c, x in cols.items():
        np.testing.assert_allclose([got[c, p] for p in PROBS], np.quantile(x, PROBS), rtol=1e-12, err_msg=c)
    assert rounds[0] == n and (margin == 0 or rounds[1] < 0.05 * n)  # a bracket holds a small share after one round


def test_nulls_nan_infinity_and_nothing(spark):
    df = _frame(spark, x=[None, float("nan"), 3, 1, float("inf"), 2], none=[None] * 6)
    got = exact_quantiles(df, ["x", "none"], (0.0, 0.5, 1.0), limit=1)
    assert [got["x", p] for p in (0.0, 0.5, 1.0)] == [1.0, 2.5, float("inf")]
    assert got["none", 0.5] is None
    assert exact_quantiles(df.limit(0), ["x"], (0.5,)) == {("x", 0.5): None}
    assert exact_quantiles(df, [], (0.5,)) == {}


def test_describe_has_a_row_for_every_numeric_column(spark):
    df = spark.createDataFrame([(i, float(i % 7), "a") for i in range(101)] + [(None, None, None)], "i long, d double, s string")
    rows = {r.column_name: r for r in ex.describe(df).collect()}
    assert set(rows) == {"i", "d"} and rows["i"]["count"] == 101
    assert (rows["i"].q25, rows["i"].q50, rows["i"].q75, rows["i"].max) == (25.0, 50.0, 75.0, 100.0)
    assert rows["d"].q50 == float(np.quantile([i % 7 for i in range(101)], 0.5))
    assert ex.describe(df.select("s")).count() == 0 and ex.describe(df.limit(0)).count() == 2
