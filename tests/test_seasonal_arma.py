"""The multiplicative seasonal model: its parameters, its minimum, and its forecasts."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.models import seasonal_ar
from tideline.models import seasonal_arma as arma
from tideline.operators import horizon as hz
from tideline.session import materialize

KEY = "state"


def simulated(phi, big_phi, theta, big_theta, n, seed):
    r = np.random.default_rng(seed)
    e = r.normal(size=n + 60)
    w = np.zeros(n + 60)
    on_w, on_e, _, _ = arma.lag_weights(np.array([[*phi, big_phi, *theta, big_theta]]), len(phi), len(theta))
    for t in range(9, n + 60):
        w[t] = e[t] + sum(on_w[0, k] * w[t - 1 - k] + on_e[0, k] * e[t - 1 - k] for k in range(9))
    return w[60:]


def plain(beta, w, first, p, q):
    """Residuals of one series, term by term."""
    phi, big_phi, theta, big_theta = beta[:p], beta[p], beta[p + 1 : p + 1 + q], beta[p + 1 + q]
    a = np.convolve([1, *[-x for x in phi]], [1, *[0] * 6, -big_phi])
    m = np.convolve([1, *theta], [1, *[0] * 6, big_theta])
    e = np.zeros(len(w))
    for t in range(first, len(w)):
        e[t] = sum(a[k] * w[t - k] for k in range(len(a)) if t >= k)
        e[t] -= sum(m[k] * e[t - k] for k in range(1, len(m)) if t >= k)
    return e


@pytest.mark.parametrize(("p", "q"), [(0, 0), (1, 0), (0, 2), (2, 1), (2, 2)])
def test_residuals_and_slopes(p, q):
    r = np.random.default_rng(p + 5 * q)
    w = r.normal(size=(3, 60))
    counted = np.zeros((3, 60), dtype=bool)
    counted[:, 9:], counted[2, 50:] = True, False
    beta = r.uniform(-0.4, 0.4, size=(3, p + q + 2))
    e, jac = arma.residuals(beta, w, counted, p, q)
    for i in range(2):
        assert e[i] == pytest.approx(plain(beta[i], w[i], 9, p, q))
    assert not e[2, 50:].any()
    for k in range(beta.shape[1]):
        up, down = beta.copy(), beta.copy()
        up[:, k] += 1e-6
        down[:, k] -= 1e-6
        change = (arma.residuals(up, w, counted, p, q, False)[0] - arma.residuals(down, w, counted, p, q, False)[0]) / 2e-6
        assert jac[:, :, k] == pytest.approx(change, abs=1e-6)


def test_parameters_are_found():
    true = np.array([0.5, -0.2, 0.6, 0.4, 0.3])  # two phi, Phi, one theta, Theta
    w = np.stack([simulated(true[:2], true[2], true[3:4], true[4], 3000, seed) for seed in (1, 2)])
    counted = np.zeros(w.shape, dtype=bool)
    counted[:, 9:] = True
    beta, e = arma.minimise(w, counted, np.zeros((2, 5)), 2, 1)
    assert beta == pytest.approx(np.tile(true, (2, 1)), abs=0.08)
    own = (arma.residuals(np.tile(true, (2, 1)), w, counted, 2, 1, False)[0] ** 2).sum(axis=1)
    assert ((e**2).sum(axis=1) <= own).all()
    # At a minimum the slopes of the sum of squares vanish.
    _, jac = arma.residuals(beta, w, counted, 2, 1)
    slope = np.einsum("ntk,nt->nk", jac, e) / (e**2).sum(axis=1)[:, None]
    assert np.abs(slope).max() < 1e-3


@pytest.fixture(scope="module")
def history(spark):
    rows = []
    for state, seed, n in (("A", 3, 420), ("B", 4, 300), ("C", 5, 25)):
        w = simulated([0.4], 0.3, [0.2], -0.6, n, seed)
        y = np.full(n, 1000.0)
        for t in range(7, n):
            y[t] = y[t - 7] + 10 * w[t]
        rows += [(state, date(2023, 1, 1) + timedelta(days=t), float(y[t])) for t in range(n)]
    return materialize(spark.createDataFrame(rows, "state string, ds date, total double"))


def test_grid_has_products_and_the_right_number_of_parameters(history):
    orders = [(1, 0, 1), (2, 0, 0), (2, 1, 2)]
    found = {(r.state, r.grid_id): r for r in arma.fit_grid(history, orders).collect()}
    linear = {(r.state, r.grid_id): r for r in seasonal_ar.fit_grid(history, orders).collect()}
    assert found.keys() == linear.keys() == {(s, i) for s in "AB" for i in range(3)}
    for (state, i), r in found.items():
        p, d, q = orders[i]
        c = np.array(r.coefficients)
        assert c[3:5] == pytest.approx(-c[:2] * c[2]) and c[8:10] == pytest.approx(c[5:7] * c[7])
        assert (c[:2] != 0).sum() == p and (c[5:7] != 0).sum() == q
        assert (r.tail_w, r.tail_y, r.unit) == (linear[state, i].tail_w, linear[state, i].tail_y, linear[state, i].unit)
        y = [x.total for x in history.filter(F.col(KEY) == state).orderBy("ds").collect()]
        w = np.array(y[7:]) - np.array(y[:-7])
        w = (w[1:] - w[:-1] if d else w) / r.unit
        beta = [*c[:p], c[2], *c[5 : 5 + q], c[7]]
        e = plain(beta, w, 17 - 7 - d, p, q)
        assert r.n == len(w) - (17 - 7 - d)
        assert r.tail_e == pytest.approx(list(e[-9:]), abs=1e-9)
        assert r.aic == pytest.approx(r.n * np.log((e**2).sum() / r.n) + 2 * (p + q + 2))
    best = {r.state: r.grid_id for r in arma.tune(history, orders).collect()}
    assert best == {s: min(range(3), key=lambda i: (found[s, i].aic, i)) for s in "AB"}


def test_forecast(history):
    fit = seasonal_ar.with_fallback(arma.tune(history, [(1, 0, 1)]), history)
    targets = hz.future_dates(hz.last_days(history), 10).select(KEY, "ds")
    found = seasonal_ar.predict_seasonal_ar(fit, targets).collect()
    assert len(found) == 30 and all(r.yhat is not None and r.yhat >= 0 for r in found)
