"""Calendar grid, filling, windows, splits: against pandas and by hand."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from yieldwatch.functions.calendar import calendar_columns
from yieldwatch.operators import features, grid
from yieldwatch.operators.audit import lookahead_audit
from yieldwatch.operators.evaluate import rolling_rmse
from yieldwatch.operators.grid import fill_missing
from yieldwatch.operators.halo import row_windows
from yieldwatch.operators.joins import join_summary
from yieldwatch.operators.scaling import minmax_scale, normalize_series
from yieldwatch.operators.split import chrono_split, hash_split, split_dates

D = dt.date


def gappy_series():
    """Three series: gaps over year ends, a sparse one, and one of a single row."""
    rng = np.random.default_rng(7)
    rows = []
    days = pd.date_range("2019-11-01", "2022-02-15")
    for day in days[rng.random(len(days)) < 0.6]:
        rows.append(("a", day.date(), float(rng.normal(100, 10))))
    for year in range(1990, 2030):
        rows.append(("b", D(year, 6, 1), float(rng.normal(5, 1))))
    rows.append(("c", D(2020, 2, 29), 1.0))
    return pd.DataFrame(rows, columns=["series_id", "date", "value"])


def pandas_features(frame):
    parts = []
    for _, g in frame.sort_values("date").groupby("series_id"):
        g = g.copy()
        v = g["value"]
        for k in (1, 5, 10):
            g[f"lag{k}"] = v.shift(k)
        for n in (7, 30):
            g[f"roll_mean_{n}"] = v.rolling(n, min_periods=1).mean()
            g[f"roll_std_{n}"] = v.rolling(n, min_periods=1).std()
        g["return"] = v / v.shift(1) - 1
        g["return_lag1"] = g["return"].shift(1)
        g["diff"] = v.diff()
        g["diff_pct"] = g["return"]
        g["ma_crossover"] = g["roll_mean_7"] - g["roll_mean_30"]
        parts.append(g)
    return pd.concat(parts).sort_values(["series_id", "date"]).reset_index(drop=True)


def ordered(df):
    return df.toPandas().sort_values(["series_id", "date"]).reset_index(drop=True)


def same_numbers(got, want, columns):
    for c in columns:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_features_by_counting_rows_match_pandas(spark):
    frame = gappy_series()
    got = ordered(features.time_features(spark.createDataFrame(frame)))
    want = pandas_features(frame)
    assert list(got["date"]) == list(want["date"])
    same_numbers(got, want, [c for c in want.columns if c not in ("series_id", "date")])


def test_daily_halo_equals_counted_halo(spark):
    clean = grid.uniform_calendar(spark.createDataFrame(gappy_series()), ts="date")
    daily = ordered(features.time_features(clean, daily=True))
    counted = ordered(features.time_features(clean))
    assert len(daily) == len(counted)
    pd.testing.assert_frame_equal(daily[sorted(daily.columns)], counted[sorted(counted.columns)])


def test_result_does_not_depend_on_row_order_or_partitions(spark):
    df = spark.createDataFrame(gappy_series())
    one = ordered(features.all_features(df.orderBy("value").coalesce(1)))
    many = ordered(features.all_features(df.repartition(13)))
    pd.testing.assert_frame_equal(one, many)


def test_leak_free_moves_same_row_features_one_row_back(spark):
    df = spark.createDataFrame(gappy_series())
    plain = ordered(features.time_features(df))
    safe = ordered(features.time_features(df, leak_free=True))
    for c in ("return", "return_lag1", "diff", "roll_mean_7", "roll_std_30", "ma_crossover"):
        shifted = plain.groupby("series_id")[c].shift(1)
        np.testing.assert_allclose(safe[c].astype(float), shifted.astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_zero_base_gives_null_return(spark):
    df = spark.createDataFrame([("a", D(2020, 1, i), v) for i, v in ((1, 0.0), (2, 3.0), (3, 6.0))], ["series_id", "date", "value"])
    got = ordered(features.time_features(df))
    assert got["return"].isna().tolist() == [True, True, False]
    assert got["diff"].tolist()[1:] == [3.0, 3.0]


def test_warmup_drops_by_position_and_short_series_vanish(spark):
    df = spark.createDataFrame(gappy_series())
    kept = features.drop_warmup(df, rows=10).groupBy("series_id").count().toPandas().set_index("series_id")["count"]
    total = gappy_series().groupby("series_id").size()
    assert kept["a"] == total["a"] - 10 and kept["b"] == 30 and "c" not in kept


def test_sequences(spark):
    rows = [("a", D(2020, 1, 1) + dt.timedelta(i), float(i), float(-i)) for i in range(40)]
    df = spark.createDataFrame(rows, ["series_id", "date", "value", "f"])
    got = features.sequences(df, ["f"], "value", length=30).orderBy("date").collect()
    assert len(got) == 10
    first = got[0]
    assert first["y"] == 30.0 and first["date"] == D(2020, 1, 31)
    assert [x["v"] for x in first["x"]] == [[float(i), float(-i)] for i in range(30)]


def test_wide_table_has_series_features_and_calendar(spark):
    rows = [(s, D(2020, 1, 1) + dt.timedelta(i), float(i * k)) for s, k in (("x 1", 1), ("y", 2)) for i in range(40)]
    df = spark.createDataFrame(rows, ["series_id", "date", "value"])
    wide = features.feature_table(df, {"x 1": "x", "y": "y"}, daily=True)
    assert len(wide.columns) == 1 + 2 + 2 * 12 + 14
    row = wide.orderBy("date").first()
    assert wide.count() == 30 and row["date"] == D(2020, 1, 11)
    assert (row["x"], row["y"], row["x_lag10"], row["y_diff"], row["x_roll_mean_7"]) == (10.0, 20.0, 0.0, 2.0, 7.0)


def test_uniform_calendar_takes_the_last_value_at_or_before_midnight(spark):
    ts = dt.datetime
    rows = [
        ("s", ts(2024, 1, 1, 9), 1.0),
        ("s", ts(2024, 1, 1, 17), 2.0),
        ("s", ts(2024, 1, 3, 0), 3.0),
        ("s", ts(2024, 1, 5, 12), 4.0),
        ("s", ts(2024, 1, 4, 1), None),
        ("one", ts(2024, 2, 1, 8), 7.0),
    ]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, value double")
    got = {(r.series_id, r.date.day): r.value for r in grid.uniform_calendar(df).collect()}
    assert got == {
        ("s", 1): None, ("s", 2): 2.0, ("s", 3): 3.0, ("s", 4): 3.0, ("s", 5): 3.0, ("one", 1): None,
    }
    back = {(r.series_id, r.date.day): r.value for r in grid.uniform_calendar(df, leading="backfill").collect()}
    assert back[("s", 1)] == 2.0 and back[("one", 1)] == 7.0 and back[("s", 4)] == 3.0


def test_fill_missing_crosses_chunks_and_backfills_only_the_start(spark):
    frame = gappy_series()
    frame["value"] = [None if i % 3 else v for i, v in enumerate(frame["value"])]
    frame.loc[frame["series_id"] == "c", "value"] = None
    frame.loc[frame["date"] < D(2020, 3, 1), "value"] = frame["value"].where(frame["series_id"] == "b")
    df = spark.createDataFrame(frame, "series_id string, date date, value double")
    want = frame.sort_values(["series_id", "date"]).copy()
    forward = want.groupby("series_id")["value"].ffill()
    want["full"] = forward.groupby(want["series_id"]).bfill()
    np.testing.assert_array_equal(ordered(grid.fill_missing(df))["value"].astype(float), want["full"].astype(float))
    strict = ordered(grid.fill_missing(df, leading="null"))["value"]
    np.testing.assert_array_equal(strict.astype(float), forward.astype(float))


def test_calendar_columns_match_pandas(spark):
    days = pd.to_datetime(["2020-02-29", "2019-12-31", "2020-12-31", "2021-01-03", "2024-03-31", "2023-06-30", "2023-07-31"])
    df = spark.createDataFrame([(d.date(),) for d in days], "date date").withColumns(calendar_columns(F.col("date")))
    got = df.toPandas()
    assert list(got["day_of_week"]) == list(days.dayofweek)
    assert list(got["day_of_year"]) == list(days.dayofyear)
    assert list(got["week_of_year"]) == list(days.isocalendar().week)
    assert list(got["is_month_end"]) == list(days.is_month_end.astype(int))
    assert list(got["is_quarter_end"]) == list(days.is_quarter_end.astype(int))
    assert list(got["quarter"]) == list(days.quarter)
    np.testing.assert_allclose(got["month_sin"], np.sin(2 * np.pi * days.month / 12))


def test_date_key_check_counts_nulls_and_duplicates(spark):
    rows = [("a", D(2020, 1, 1)), ("a", D(2020, 1, 1)), ("a", D(2020, 1, 2)), (None, D(2020, 1, 1)), ("b", None)]
    df = spark.createDataFrame(rows, "series_id string, date date")
    assert tuple(grid.date_key_check(df).first()) == (5, 2, 1, 2)


@pytest.mark.parametrize("test_size", [0.2, 0.0, 1.0, 0.5])
def test_chrono_split_takes_the_first_rows(spark, test_size):
    frame = gappy_series()
    df = spark.createDataFrame(frame)
    got = ordered(chrono_split(df, test_size=test_size))
    for _, g in got.groupby("series_id"):
        n = int(len(g) * (1 - test_size))
        assert list(g["split"]) == ["train"] * n + ["test"] * (len(g) - n)


def test_chrono_split_without_keys(spark):
    df = spark.createDataFrame(gappy_series()).filter("series_id = 'a'").drop("series_id")
    got = chrono_split(df, ()).toPandas().sort_values("date")
    n = int(len(got) * 0.8)
    assert list(got["split"]) == ["train"] * n + ["test"] * (len(got) - n)
    cut = split_dates(df, ()).first()
    assert cut["n_train"] == n and cut["cutoff"] == got["date"].iloc[n]


def test_hash_split_is_stable_and_about_right(spark):
    ids = spark.range(5000).withColumnRenamed("id", "k")
    first = hash_split(ids, "k").filter("split = 'test'").count()
    assert first == hash_split(ids.repartition(7), "k").filter("split = 'test'").count()
    assert 900 < first < 1100


def test_rolling_rmse_matches_pandas(spark):
    frame = gappy_series().rename(columns={"series_id": "target", "value": "actual"})
    frame["model"], frame["predicted"] = "m", 10.0
    got = rolling_rmse(spark.createDataFrame(frame)).toPandas().sort_values(["target", "date"])
    squared = (frame["actual"] - 10.0) ** 2
    want = (
        frame.assign(s=squared).sort_values(["target", "date"]).groupby("target")["s"]
        .rolling(30, min_periods=1).mean() ** 0.5
    )
    np.testing.assert_allclose(got["rolling_rmse"], want.to_numpy(), rtol=1e-9)


def test_scaling(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 3.0, 5.0), ("b", 2.0, 5.0)], ["series_id", "value", "flat"])
    got = minmax_scale(df, ["value", "flat"]).orderBy("series_id", "value").toPandas()
    assert got["value_scaled"].tolist() == [0.0, 1.0, 0.5] and got["flat_scaled"].tolist() == [0.0] * 3
    norm = normalize_series(df).orderBy("series_id", "value").toPandas()
    assert norm["minmax"].tolist() == [0.0, 1.0, 0.0]
    np.testing.assert_allclose(norm["zscore"][:2], [-(0.5**0.5), 0.5**0.5])
    assert norm["zscore"].isna().tolist() == [False, False, True]


def test_summary_joins_choose_by_size_and_keep_null_keys(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), "id")
    summary = rows.groupBy("k").agg(F.sum("id").alias("s"))
    out = join_summary(rows, summary, ["k"])
    assert out.count() == 1000 and out.columns == ["k", "id", "s"]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" in out._jdf.queryExecution().sparkPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = join_summary(rows, summary, ["k"])
        assert "Broadcast" not in large._jdf.queryExecution().sparkPlan().toString()
        assert sorted(large.collect(), key=str) == sorted(out.collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_null_series_keep_their_rows_and_their_windows(spark):
    days = [D(2019, 12, 20) + dt.timedelta(i) for i in range(40)]
    rows = [(s, d, float(i) if i % 7 else None) for s in ("a", None) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "series_id string, date date, value double")
    filled = fill_missing(df)
    for out in (filled, chrono_split(df), normalize_series(df), features.time_features(filled), features.time_features(filled, daily=True)):
        groups = {s: sorted(str(tuple(r)[1:]) for r in out.select("series_id", *sorted(set(out.columns) - {"series_id"})).collect() if r["series_id"] == s) for s in ("a", None)}
        assert groups["a"] == groups[None] and groups["a"]
    assert chrono_split(df).count() == 80


def test_daily_windows_may_be_longer_than_a_year(spark):
    rows = [("a", D(2018, 1, 1) + dt.timedelta(i), float(i)) for i in range(1200)]
    df = spark.createDataFrame(rows, "series_id string, date date, value double")

    def build(w):
        return {"m": F.avg("value").over(w.rowsBetween(-899, 0))}

    daily = row_windows(df, ["series_id"], "date", 899, build, daily=True).collect()
    counted = row_windows(df, ["series_id"], "date", 899, build).collect()
    assert sorted(daily) == sorted(counted) and len(daily) == 1200


def test_audit_finds_whole_table_columns_only(spark):
    rows = [("a", D(2020, 1, 1) + dt.timedelta(i), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, ["series_id", "date", "value"])

    def build(source):
        return features.time_features(minmax_scale(source, ["value"]))

    report = {r.feature: r.uses_future for r in lookahead_audit(df, build, D(2020, 2, 1)).collect()}
    assert report.pop("value_scaled") is True
    assert not any(report.values()) and "roll_mean_30" in report
