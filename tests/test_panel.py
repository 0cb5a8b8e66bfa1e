import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import panel as ops
from panelcast.operators.vectors import series_vectors
from panelcast.spec import Cutoffs, PanelSpec
from tests.conftest import SPEC, days, facts, rows

CUT = Cutoffs(date(2022, 9, 12), 728, 7)


def test_gaps_become_zero_up_to_the_day_before_execution(spark):
    df = facts(spark, [(1, 1, date(2022, 8, 29), 1.0), (1, 1, date(2022, 9, 10), 7.0)])
    got = ops.make_panel(df, SPEC, CUT).orderBy("date").collect()
    assert [r["date"] for r in got] == [date(2022, 8, 29) + timedelta(days=i) for i in range(14)]
    assert [r["sales"] for r in got] == [1.0, *[0.0] * 11, 7.0, 0.0]
    assert [r["split"] for r in got] == ["train"] * 7 + ["test"] * 7
    assert list(got[0].asDict()) == ["store", "item", "date", "sales", "split"]


def test_full_series_is_kept_as_it_is(spark):
    df = facts(spark, days(date(2018, 12, 1), range(1, 31)))
    got = ops.make_panel(df, SPEC, Cutoffs(date(2018, 12, 31), 727, 5)).orderBy("date").collect()
    assert [r["sales"] for r in got] == list(map(float, range(1, 31)))
    assert [r["split"] for r in got] == ["train"] * 25 + ["test"] * 5


def test_each_series_starts_on_its_own_first_day_in_the_window(spark):
    cut = Cutoffs(date(2022, 9, 12), 10, 3)
    df = facts(
        spark,
        [(1, 1, date(2022, 9, 1), 5.0), (1, 1, date(2022, 9, 4), 2.0)],  # first fact before the window
        [(1, 2, date(2022, 9, 9), 3.0)],
        [(2, 1, date(2022, 8, 1), 9.0)],  # nothing inside
        [(2, 2, date(2022, 9, 12), 9.0)],  # the execution date itself is outside
    )
    got = {(r["store"], r["item"]): r for r in ops.make_panel(df, SPEC, cut).groupBy("store", "item").agg(F.min("date").alias("a"), F.max("date").alias("b"), F.sum("sales").alias("s")).collect()}
    assert set(got) == {(1, 1), (1, 2)}
    assert (got[1, 1]["a"], got[1, 1]["b"], got[1, 1]["s"]) == (date(2022, 9, 4), date(2022, 9, 11), 2.0)
    assert got[1, 2]["a"] == date(2022, 9, 9)


def test_duplicates_add_up_nulls_count_as_zero_and_null_keys_are_a_series(spark):
    d = date(2022, 9, 10)
    df = facts(spark, [(1, 1, d, 2.0), (1, 1, d, 3.0), (1, 1, d + timedelta(days=1), None), (None, 1, d, 4.0)])
    got = rows(ops.gap_fill(ops.daily_panel(df, SPEC), SPEC, CUT))
    assert got == sorted(
        [(1, 1, d, 5.0), (1, 1, d + timedelta(days=1), 0.0), (None, 1, d, 4.0), (None, 1, d + timedelta(days=1), 0.0)], key=repr
    )


def test_extra_columns_and_timestamps_are_accepted(spark):
    df = facts(spark, days(date(2022, 9, 8), [1, 2])).withColumn("note", F.lit("x"))
    df = df.withColumn("date", F.to_timestamp(F.col("date")) + F.expr("interval 13 hours"))
    assert [r["sales"] for r in ops.make_panel(df, SPEC, CUT).orderBy("date").collect()] == [1.0, 2.0, 0.0, 0.0]


def test_weekly_steps_sum_periods_and_leave_out_incomplete_ones(spark):
    spec = PanelSpec(SPEC.keys, SPEC.time, SPEC.value, step_days=7)
    cut = Cutoffs(date(2022, 9, 12), 10, 2, step_days=7)
    first = date(2022, 8, 17)  # a Wednesday: the last period reaches past the execution date
    df = facts(spark, days(first, [1.0] * 26))
    got = ops.make_panel(df, spec, cut).orderBy("date").collect()
    assert [r["date"] for r in got] == [first, first + timedelta(days=7), first + timedelta(days=14)]
    assert [r["sales"] for r in got] == [7.0, 7.0, 7.0]
    vec = series_vectors(ops.daily_panel(ops.clip(df, spec, cut), spec), spec, cut).first()
    assert vec["ys"] == [7.0, 7.0, 7.0] and vec["start"] == first
    assert vec["n_train"] == sum(r["split"] == "train" for r in got)


@pytest.mark.parametrize("step", [1, 3])
def test_fill_and_vectors_agree_with_pandas_on_random_facts(spark, step):
    rng = random.Random(step)
    spec = PanelSpec(SPEC.keys, SPEC.time, SPEC.value, step_days=step)
    cut = Cutoffs(date(2022, 9, 12), 60, 5, step_days=step)
    data = [
        (s, i, cut.start + timedelta(days=rng.randrange(-10, 60 * step + 10)), float(rng.randrange(1, 9)))
        for s in range(3) for i in range(4) for _ in range(rng.randrange(1, 30))
    ]
    expected = {}
    for key, part in pd.DataFrame(data, columns=["s", "i", "t", "y"]).groupby(["s", "i"]):
        part = part[(part.t >= cut.start) & (part.t <= cut.end)]
        if part.empty:
            continue
        first, sums = part.t.min(), {}
        for t, y in zip(part.t, part.y):
            sums[(t - first).days // step] = sums.get((t - first).days // step, 0.0) + y
        n = (cut.execution_date - first).days // step
        if n:
            expected[tuple(map(int, key))] = (first, [sums.get(j, 0.0) for j in range(n)])
    daily = ops.daily_panel(ops.clip(facts(spark, data), spec, cut), spec)
    filled = {}
    for r in ops.gap_fill(daily, spec, cut).orderBy("date").collect():
        filled.setdefault((r["store"], r["item"]), []).append((r["date"], r["sales"]))
    assert {k: (v[0][0], [y for _, y in v]) for k, v in filled.items()} == expected
    got = {(r["store"], r["item"]): (r["start"], r["ys"]) for r in series_vectors(daily, spec, cut).collect()}
    assert got == expected


def test_vectors_are_the_same_from_sparse_and_filled_panels(spark):
    df = facts(spark, [(1, 1, date(2022, 8, 29), 1.0), (1, 1, date(2022, 9, 10), 7.0)], days(date(2022, 9, 1), [3, 0, 4], 2))
    daily = ops.daily_panel(df, SPEC)
    sparse = series_vectors(daily, SPEC, CUT)
    filled = series_vectors(ops.gap_fill(daily, SPEC, CUT), SPEC, CUT, tasks=3)
    assert rows(sparse) == rows(filled)
    assert {r["store"]: r["n_train"] for r in sparse.collect()} == {1: 7, 2: 4}


def test_fill_needs_no_join_and_filter_reaches_the_scan(spark, tmp_path):
    facts(spark, days(date(2022, 9, 1), range(5))).write.parquet(str(tmp_path / "f"))
    df = ops.make_panel(spark.read.parquet(str(tmp_path / "f")), SPEC, CUT)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2020-09-14), LessThan(date,2022-09-12)]" in plan


def test_facts_can_be_placed_by_series_in_one_shuffle(spark):
    rng = random.Random(7)
    data = [
        (s, 1, date(2022, 8, 1) + timedelta(days=rng.randrange(40)), float(rng.randrange(9)))
        for s in range(5) for _ in range(60)
    ]
    df = facts(spark, data)
    one = ops.make_panel(df, SPEC, CUT, tasks=3, few_per_day=True)
    assert one._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    two = ops.make_panel(df, SPEC, CUT, tasks=3)
    assert two._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2
    assert rows(one) == rows(two) == rows(ops.make_panel(df, SPEC, CUT))
    vec = series_vectors(ops.daily_panel(ops.clip(df, SPEC, CUT), SPEC, tasks=3), SPEC, CUT)
    assert vec._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert rows(vec) == rows(series_vectors(ops.daily_panel(ops.clip(df, SPEC, CUT), SPEC), SPEC, CUT))
    with pytest.raises(ValueError):
        ops.make_panel(df, SPEC, CUT, few_per_day=True)


def test_a_hot_series_is_summed_before_the_shuffle(spark):
    """One series holds a third of the facts, many on the same day."""
    hot = spark.range(40_000).selectExpr(
        "1 AS store", "1 AS item", "date_sub(date'2022-09-11', cast(id % 3 AS int)) AS date", "1.0D AS sales"
    )
    rest = spark.range(80_000).selectExpr(
        "cast(2 + id % 500 AS int) AS store", "1 AS item", "date_sub(date'2022-09-11', cast(id % 40 AS int)) AS date", "1.0D AS sales"
    )
    df = hot.unionByName(rest)
    daily = ops.daily_panel(ops.clip(df, SPEC, CUT), SPEC)
    text = daily._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_sum") > text.index("Exchange ")  # printed from the last step to the first
    assert daily.groupBy().agg(F.sum("sales")).first()[0] == 120_000.0
    got = {r["store"]: r["ys"] for r in series_vectors(daily, SPEC, CUT).filter("store = 1").collect()}
    assert sum(got[1]) == 40_000.0 and len(got[1]) == 3


def test_key_filter(spark):
    df = facts(spark, days(date(2022, 9, 1), [1], 1), days(date(2022, 9, 1), [2], 2), days(date(2022, 9, 1), [3], 3))
    assert ops.filter_keys(df, "store", None).count() == 3
    assert ops.filter_keys(df, "store", []).count() == 3
    assert [r["store"] for r in ops.filter_keys(df, "store", [2, 3]).orderBy("store").collect()] == [2, 3]
    wanted = spark.createDataFrame([(1,), (1,), (9,)], "store int")
    assert [r["store"] for r in ops.filter_keys(df, "store", wanted).collect()] == [1]


def test_series_count_and_grid_check(spark):
    regular = days(date(2022, 9, 1), [1, 2, 3], 1)
    holed = [(2, 1, date(2022, 9, 1), 1.0), (2, 1, date(2022, 9, 4), 1.0)]
    doubled = [(3, 1, date(2022, 9, 1), 1.0)] * 2 + [(3, 1, date(2022, 9, 2), 1.0)]
    df = facts(spark, regular, holed, doubled)
    assert ops.series_count(df, SPEC).first()["n_series"] == 3
    assert ops.series_count(df, SPEC, approximate=True).first()["n_series"] == 3
    got = {r["store"]: r for r in ops.grid_check(df, SPEC).collect()}
    assert [got[s]["regular"] for s in (1, 2, 3)] == [True, False, False]
    assert (got[2]["irregular"], got[2]["n_expected"], got[3]["duplicates"]) == (1, 4, 1)


def test_profile_names_the_models_a_series_is_long_enough_for(spark):
    df = facts(spark, days(date(2022, 9, 1), [1, 0, 3], 1), days(date(2022, 9, 10), [0], 2))
    got = {r["store"]: r for r in ops.series_profile(ops.daily_panel(df, SPEC), SPEC, CUT, {"a": 1, "b": 4, "c": 5}).collect()}
    assert (got[1]["n_points"], got[1]["n_train"], got[1]["n_active"], got[1]["eligible"]) == (11, 4, 2, "a,b")
    assert got[1]["last_active_day"] == date(2022, 9, 3)
    assert (got[2]["n_train"], got[2]["eligible"], got[2]["last_active_day"]) == (0, "", None)
    assert got[1]["zero_share"] == pytest.approx(9 / 11)


def test_lags_need_a_full_history(spark):
    df = facts(spark, days(date(2022, 9, 1), [1, 2, 3, 4], 1), days(date(2022, 9, 1), [5, 6], 2))
    got = rows(ops.lag_features(df, SPEC, 2))
    assert got == [(1, 1, date(2022, 9, 3), 3.0, 2.0, 1.0), (1, 1, date(2022, 9, 4), 4.0, 3.0, 2.0)]


def test_execution_window_and_split_selection(spark):
    df = facts(spark, days(date(2022, 9, 1), range(11)))
    got = ops.execution_window(df, SPEC, 728, 7).first()
    assert (got["execution_date"], got["start_date"], got["end_date"], got["train_end"]) == (
        CUT.execution_date, CUT.start, CUT.end, CUT.train_end,
    )
    panel = ops.make_panel(df, SPEC, CUT)
    assert ops.only(panel, "train").count() == 4 and ops.only(panel, "test").count() == 7
    with pytest.raises(ValueError):
        ops.only(panel, "valid")
