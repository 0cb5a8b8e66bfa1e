from datetime import date, datetime, timezone

import pytest

from panelcast import Cutoffs, PanelSpec, Workflow, today_in
from tests.conftest import SPEC


def test_cutoffs_count_back_from_the_execution_date():
    cut = Cutoffs(date(2022, 9, 12), 728, 7)
    assert (cut.start, cut.end, cut.train_end) == (date(2020, 9, 14), date(2022, 9, 11), date(2022, 9, 4))
    weekly = Cutoffs(date(2022, 9, 12), 10, 2, step_days=7)
    assert (weekly.start, weekly.end, weekly.train_end) == (date(2022, 7, 4), date(2022, 9, 11), date(2022, 8, 28))


@pytest.mark.parametrize("bad", [{"window": 0}, {"test_size": 0}, {"test_size": -1}, {"window": 5, "test_size": 5}, {"step_days": 0}])
def test_cutoffs_refuse_sizes_without_training_days(bad):
    with pytest.raises(ValueError):
        Cutoffs(date(2022, 1, 1), **bad)


@pytest.mark.parametrize("keys,time,value", [((), "t", "y"), (("a", "a"), "t", "y"), (("model",), "t", "y"), (("a",), "a", "y")])
def test_spec_refuses_unclear_columns(keys, time, value):
    with pytest.raises(ValueError):
        PanelSpec(keys, time, value)


def test_today_depends_on_the_time_zone():
    now = datetime(2022, 9, 12, 2, 30, tzinfo=timezone.utc)
    assert today_in("America/Santiago", now) == date(2022, 9, 11)
    assert today_in("UTC", now) == date(2022, 9, 12)
    with pytest.raises(ValueError):
        today_in("UTC", datetime(2022, 9, 12))


def test_workflow_refuses_settings_that_cannot_work():
    cut = Cutoffs(date(2022, 1, 1), 100, 7)
    for bad in ({"steps": 0}, {"metrics": ("rmse",)}, {"metrics": ("nonsense", "mape")}, {"buckets": 0}):
        with pytest.raises(ValueError):
            Workflow("db", SPEC, cut, **bad)
    with pytest.raises(ValueError):
        Workflow("db", SPEC, Cutoffs(date(2022, 1, 1), 100, 7, step_days=7))
