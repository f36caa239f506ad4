"""Distribution drift between the training and the test rows of a feature table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldwatch.operators.prefix import prefix_sums

BINS = 10
THRESHOLD = 0.25
#: Up to this size of the larger sample the p-value of the two-sample test is exact.
EXACT_MOST = 10_000
SIGNIFICANT, STABLE = "Significant", "Stable"


def _number(name: str) -> str:
    """A column as double in SQL, NULL for NaN."""
    column = "`" + name.replace("`", "``") + "`"
    return f"CASE WHEN NOT isnan({column}) THEN CAST({column} AS DOUBLE) END"


def feature_values(df: DataFrame, features: Sequence[str], split: str) -> DataFrame:
    """(position, value, is_train): one row per known value, no shuffle.

    `position` is the place in `features`; the name is put back after counting.
    """
    cells = ", ".join(f"struct({i} AS position, {_number(name)} AS value)" for i, name in enumerate(features))
    return df.select((F.col(split) == "train").alias("is_train"), F.expr(f"inline(array({cells}))")).filter(
        F.col("value").isNotNull()
    )


def _feature_name(features: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(name) for name in features]), F.col("position")).alias("feature")


def _edges(low: Column, high: Column, bins: int) -> Column:
    """The bins of one feature: the very first edge, then start + i * step up to end.

    Edges are even between the lowest and highest training value; the first one lies a
    thousandth of the range lower. A constant is widened by a thousandth of its value (or
    0.001) on both sides instead.
    """
    pad = F.when(low == 0, F.lit(0.001)).otherwise(F.abs(low) * 0.001)
    flat = low == high
    start = F.when(flat, low - pad).otherwise(low)
    end = F.when(flat, high + pad).otherwise(high)
    first = F.when(flat, start).otherwise(low - (high - low) * 0.001)
    return F.struct(
        first.alias("first"), start.alias("start"), ((end - start) / bins).alias("step"), end.alias("end")
    )


def _bin(x: Column, edges: Column, bins: int) -> Column:
    """1..bins for low edge < x <= high edge, 0 below and bins + 1 above.

    A value on the very first edge belongs to bin 1.
    """
    passed = (x > edges["first"]).cast("int") + (x > edges["end"]).cast("int")
    for i in range(1, bins):
        passed = passed + (x > edges["start"] + i * edges["step"]).cast("int")
    return F.when(x == edges["first"], F.lit(1)).otherwise(passed)


def bin_counts(df: DataFrame, features: Sequence[str], split: str = "split", bins: int = BINS) -> DataFrame:
    """(feature, bin, counts and sums of both sides): all features in one counting pass.

    The training edges of all features come from a one-row subquery (four numbers per
    column), and the shuffle carries at most bins + 2 rows per feature and task.
    """
    ranges = ", ".join(f"struct(min({_number(c)}) AS low, max({_number(c)}) AS high)" for c in features)
    bounds = df.filter(F.col(split) == "train").agg(F.expr(f"array({ranges})").alias("b"))
    edges = bounds.select(F.transform("b", lambda b: _edges(b["low"], b["high"], bins))).scalar()
    value, is_train = F.col("value"), F.col("is_train")
    return (
        feature_values(df, features, split)
        .select("position", "is_train", "value", F.get(edges, F.col("position")).alias("_edges"))
        .select("position", "is_train", "value", _bin(value, F.col("_edges"), bins).alias("bin"))
        .groupBy("position", "bin")
        .agg(
            F.count_if(is_train).alias("n_train"),
            F.count_if(~is_train).alias("n_test"),
            F.coalesce(F.sum(F.when(is_train, value)), F.lit(0.0)).alias("sum_train"),
            F.coalesce(F.sum(F.when(~is_train, value)), F.lit(0.0)).alias("sum_test"),
        )
        .select(_feature_name(features), "bin", "n_train", "n_test", "sum_train", "sum_test")
    )


def _psi_scores(counts: DataFrame, bins: int) -> DataFrame:
    """Per feature: PSI, totals and means, from at most bins + 2 rows per feature."""
    feature = Window.partitionBy("feature")
    shares = (
        counts.withColumn("_train", F.sum("n_train").over(feature))
        .withColumn("_test", F.sum("n_test").over(feature))
        .withColumn("_e", F.try_divide(F.col("n_train"), F.col("_train")))
        .withColumn("_a", F.try_divide(F.col("n_test"), F.col("_test")))
    )
    inside = F.col("bin").between(1, bins) & (F.col("_e") > 0)
    # Fixed value: 1e-10 keeps the logarithm finite for an empty test bin.
    term = (F.col("_a") - F.col("_e")) * F.ln(F.col("_a") / F.col("_e") + 1e-10)
    return shares.groupBy("feature").agg(
        # A mean that is not finite comes from an infinite training value: there are no even bins.
        F.when(F.abs(F.try_divide(F.sum("sum_train"), F.sum("n_train"))) < float("inf"), F.sum(F.when(inside, term))).alias("drift_score"),
        F.sum("n_train").alias("n_train"),
        F.sum("n_test").alias("n_test"),
        F.try_divide(F.sum("sum_train"), F.sum("n_train")).alias("train_mean"),
        F.try_divide(F.sum("sum_test"), F.sum("n_test")).alias("test_mean"),
    )


def psi(df: DataFrame, features: Sequence[str], split: str = "split", bins: int = BINS) -> DataFrame:
    """Population stability index per feature; NULL when a side has no values, or when an
    infinite training value leaves no bins.

    Test values outside the training range are in no bin but stay in the divisor.
    """
    scores = _psi_scores(bin_counts(df, features, split, bins), bins)
    both = (F.col("n_train") > 0) & (F.col("n_test") > 0)
    return scores.select("feature", F.when(both, F.col("drift_score")).alias("psi"), "n_train", "n_test")


def ks_statistic(df: DataFrame, features: Sequence[str], split: str = "split") -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per feature, its p-value, and the means.

    p is exact where neither sample has more than EXACT_MOST values, asymptotic beyond.
    """
    values = feature_values(df, features, split)
    counts = values.groupBy("position", "value").agg(
        F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_test")
    )
    running = prefix_sums(counts, ["position"], "value", ["n_train", "n_test"])
    below_train = F.try_divide(F.col("before_n_train") + F.col("n_train"), F.col("total_n_train"))
    below_test = F.try_divide(F.col("before_n_test") + F.col("n_test"), F.col("total_n_test"))
    stats = running.groupBy("position").agg(
        F.max(F.abs(below_train - below_test)).alias("ks"),
        F.sum("n_train").alias("n_train"),
        F.sum("n_test").alias("n_test"),
        F.try_divide(F.sum(F.col("value") * F.col("n_train")), F.sum("n_train")).alias("train_mean"),
        F.try_divide(F.sum(F.col("value") * F.col("n_test")), F.sum("n_test")).alias("test_mean"),
    )
    n, m = F.col("n_train").cast("double"), F.col("n_test").cast("double")
    named = stats.withColumn("feature", _feature_name(features)).drop("position")
    return _with_exact_p(named.withColumn("p_value", _kolmogorov_tail(F.col("ks") * F.sqrt(n * m / (n + m)))), len(features))


def exact_ks_p(n: int, m: int, distance: int) -> float:
    """P(D >= distance / (n m)) for two samples of n and m values from one distribution.

    All orders of the n + m values are equally likely lattice paths. They are walked at once, one
    value at a time: `near` has the probability of each place that paths come to without
    having been as far as the distance, and what gets there is added up and left out.
    """
    if distance <= 0:
        return 1.0
    n, m = sorted((n, m))
    near, low, reached = np.ones(1), 0, 0.0  # by the number of values of the first sample, from `low` on
    for place in range(n + m):
        taken = np.arange(low, low + len(near) + 1)
        rest = n + m - place
        after = np.zeros(len(near) + 1)
        after[:-1] = near * ((m - place) + taken[:-1]) / rest
        after[1:] += near * (n - taken[:-1]) / rest
        far = np.abs(taken * (n + m) - (place + 1) * n) >= distance
        if far.any():
            reached += float(after[far].sum())
            after[far] = 0
        some = np.flatnonzero(after)
        if not len(some):
            break
        near, low = after[some[0] : some[-1] + 1], low + int(some[0])
    return min(reached, 1.0)


def _with_exact_p(stats: DataFrame, count: int) -> DataFrame:
    """Replace p by the exact one where both samples are small; one row for each of `count` features."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = []
            for row in batch.itertuples():
                small = row.n_train > 0 and row.n_test > 0 and max(row.n_train, row.n_test) <= EXACT_MOST
                places = round(row.ks * row.n_train * row.n_test) if small else 0
                p.append(exact_ks_p(int(row.n_train), int(row.n_test), places) if small else row.p_value)
            yield batch.assign(p_value=p)

    # Seconds of work for each row: a task for each.
    return stats.repartition(max(count, 1), "feature").mapInPandas(run, stats.schema)


def _kolmogorov_tail(scaled: Column, terms: int = 100) -> Column:
    """P(K > scaled): the alternating series, cut where terms no longer matter."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    # Below this point the series has not converged and the probability is 1 to 16 digits.
    return F.when(scaled < 0.1, F.lit(1.0)).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))


def feature_drift(
    df: DataFrame,
    features: Sequence[str],
    split: str = "split",
    method: str = "psi",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The drift report: one row per feature that has values on both sides."""
    if method == "psi":
        scores = _psi_scores(bin_counts(df, features, split), BINS)
        significant = F.col("drift_score") > threshold
    elif method == "ks":
        scores = ks_statistic(df, features, split).withColumnRenamed("ks", "drift_score")
        # Fixed value: 5 % level of the two-sample test.
        significant = F.col("p_value") < 0.05
    else:
        raise ValueError(f"unknown drift method: {method}")
    train, test = F.col("train_mean"), F.col("test_mean")
    return scores.filter((F.col("n_train") > 0) & (F.col("n_test") > 0)).select(
        "feature",
        "drift_score",
        F.when(significant, SIGNIFICANT).otherwise(STABLE).alias("drift_status"),
        "train_mean",
        "test_mean",
        (F.abs(F.try_divide(test - train, train + 1e-10)) * 100).alias("mean_diff_pct"),
    )


def top_drift(report: DataFrame, n: int = 5) -> DataFrame:
    """The n highest scores among the significant features."""
    return report.filter(F.col("drift_status") == SIGNIFICANT).orderBy(F.desc("drift_score"), "feature").limit(n)
