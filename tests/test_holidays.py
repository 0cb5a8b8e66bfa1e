"""Holiday tables by key, and what the panel leaves out."""

from datetime import date, timedelta

import numpy as np
import pytest

from panelcast import Cutoffs, PanelSpec, make_model
from panelcast.functions.regression import EPOCH, Decomposition
from panelcast.operators.holidays import with_holidays
from panelcast.operators.models import forecast_rows, history
from panelcast.operators.panel import left_out
from tests.conftest import SPEC, days, facts, vectors_of

FIRST = date(2022, 1, 3)


def series(seed, n=90):
    return 20 + np.random.default_rng(seed).normal(0, 1, n) + np.arange(n) / 10


def test_own_holidays_equal_an_explicit_solve():
    model = Decomposition(yearly=False, n_changepoints=3, holidays_prior_scale=0.5)
    start, n, steps = (FIRST - EPOCH).days, 90, 10
    ys = [series(i) for i in range(3)]
    own = [[(start + 5, "a"), (start + 40, "a"), (start + 92, "a"), (start + 50, "b")], [], [(start + 7, "b"), (start - 3, "b"), (start + 500, "c")]]
    got = model.forecast_with(start, ys, own, steps, 1)
    for y, pairs, row in zip(ys, own, got):
        x, penalty = model.design(start + np.arange(n + steps, dtype=float), n)
        extra = [np.isin(start + np.arange(n + steps), [d for d, k in pairs if k == name]).astype(float) for name in sorted({k for _, k in pairs})]
        x = np.column_stack([x, *extra])
        ridge = np.r_[penalty, [(model.noise_scale / 0.5) ** 2] * len(extra)]
        scale = np.abs(y).max()
        beta = np.linalg.solve(x[:n].T @ x[:n] + np.diag(ridge), x[:n].T @ (y / scale))
        assert row == pytest.approx(x[n:] @ beta * scale, rel=1e-6)
    assert got[1] == pytest.approx(model.forecast(start, [ys[1]], steps, 1)[0], rel=1e-6)


def test_holidays_lie_in_the_period_that_holds_them():
    model = Decomposition()
    columns = model.effects(100, 4, 7, [[(100, "x"), (113, "x"), (128, "x"), (99, "x")], []])
    assert columns[0, :, 0].tolist() == [1, 1, 0, 0] and not columns[1].any()


def test_tables_join_by_the_keys_they_have(spark):
    n = 60
    vec = vectors_of(spark, *[days(FIRST, series(s, n), store=s, item=i) for s in (1, 2) for i in (1, 2)], [(None, 1, FIRST + timedelta(days=t), 5.0) for t in range(n)])
    end = FIRST + timedelta(days=n)
    cut = Cutoffs(end, 400, 7)
    rows = [
        (1, FIRST + timedelta(days=10), "feast"), (1, FIRST + timedelta(days=10), "feast"), (1, end + timedelta(days=3), "feast"), (1, end + timedelta(days=30), "late"),
        (2, None, "never"), (2, FIRST, None), (None, FIRST + timedelta(days=1), "lost"), (7, FIRST, "nobody"),
    ]
    table = spark.createDataFrame(rows, "store int, day date, name string")
    got = {(r.store, r.item): r.holidays for r in with_holidays(vec, table, SPEC, cut, 7).collect()}
    assert len(got) == 5
    for i in (1, 2):
        assert [(h.day, h.name) for h in got[1, i]] == [(FIRST + timedelta(days=10), "feast"), (end + timedelta(days=3), "feast")]
        assert got[2, i] is None
    assert [h.name for h in got[None, 1]] == ["lost"]
    with pytest.raises(ValueError):
        with_holidays(vec, table.drop("store"), SPEC, cut, 7)
    assert with_holidays(vec, table.limit(0), SPEC, cut, 7).filter("holidays IS NOT NULL").count() == 0


def test_forecasts_know_the_holidays_of_their_series(spark):
    n = 84
    y = np.full(n, 10.0)
    y[[20, 41, 62]] = 40.0
    vec = vectors_of(spark, days(FIRST, y, store=1), days(FIRST, y, store=2))
    end = FIRST + timedelta(days=n)
    table = spark.createDataFrame([(1, FIRST + timedelta(days=k), "feast") for k in (20, 41, 62, n + 2)], "store int, day date, name string")
    hist = history(with_holidays(vec, table, SPEC, Cutoffs(end, 400, 7), 5), SPEC, "full", ["holidays"])
    model = make_model("Prophet", {"growth": "flat", "weekly": False, "yearly": False, "holidays_prior_scale": float("inf"), "holidays_column": "holidays"})
    got = {}
    for r in forecast_rows(hist, SPEC, [model], 5).orderBy("date").collect():
        got.setdefault(r.store, []).append(r.sales)
    assert got[1] == pytest.approx([10, 10, 40, 10, 10], abs=1e-6)
    assert got[2] == pytest.approx([10 + 90 / n] * 5, abs=1e-6)


def test_facts_of_an_incomplete_period_are_counted(spark):
    spec = PanelSpec(SPEC.keys, SPEC.time, SPEC.value, step_days=7)
    cut = Cutoffs(FIRST + timedelta(days=30), 10, 1, step_days=7)
    df = facts(spark, days(FIRST, [1.0] * 30), days(FIRST + timedelta(days=2), [2.0] * 28, store=2), days(FIRST, [3.0, 3.0], store=3), days(FIRST + timedelta(days=29), [4.0, 9.0], store=4))
    df = df.union(facts(spark, days(FIRST + timedelta(days=29), [None])))
    got = {r.store: (r.n_rows, r.total, r.first_day) for r in left_out(df, spec, cut).collect()}
    assert got == {1: (3, 2.0, FIRST + timedelta(days=28)), 4: (1, 4.0, FIRST + timedelta(days=29))}
