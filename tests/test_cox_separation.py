"""Cox fits on rows that a feature separates perfectly."""

import numpy as np
import pytest

from tidemark.models import fit_cox


def rows(spark, separable):
    """The larger the feature the earlier the event; unless ``separable``, a
    few rows break that order."""
    rng = np.random.default_rng(2)
    z = np.arange(60.0)
    d = (200 - 2 * z).astype(int)
    if not separable:
        rng.shuffle(d[::3])
    return spark.createDataFrame([(float(a), int(b), 1) for a, b in zip(z, d)], "z double, duration int, event int")


def test_separable_rows_do_not_converge(spark):
    _, metrics = fit_cox.fit(rows(spark, True), ("z",))
    assert not metrics[fit_cox.POOLED]["converged"]
    # only the rows with z = 1 have events: the likelihood flattens out
    flag = spark.createDataFrame([(float(i < 30), 1 + i if i < 30 else 100, int(i < 30)) for i in range(60)], "z double, duration int, event int")
    _, metrics = fit_cox.fit(flag, ("z",))
    assert not metrics[fit_cox.POOLED]["converged"] and metrics[fit_cox.POOLED]["reason"] == "drifting"


def test_others_do(spark):
    _, metrics = fit_cox.fit(rows(spark, False), ("z",))
    assert metrics[fit_cox.POOLED]["converged"]


@pytest.mark.parametrize("penalizer", [0.01, 0.1])
def test_a_penalizer_gives_a_finite_answer(spark, penalizer):
    models, metrics = fit_cox.fit(rows(spark, True), ("z",), penalizer=penalizer)
    assert metrics[fit_cox.POOLED]["converged"] and 0 < models[fit_cox.POOLED].coef[0] < 10


def test_step_of_a_flat_likelihood():
    assert fit_cox._next_step(np.array([1e-9]), np.array([[-1e-9]])) == pytest.approx(1.0)
    assert fit_cox._next_step(np.array([1e-9]), np.array([[0.0]])) == np.inf
