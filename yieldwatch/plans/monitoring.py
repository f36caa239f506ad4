"""Monitoring dashboards for all targets and models at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldwatch.operators.drift import feature_drift
from yieldwatch.operators.monitor import monitoring_fact, monitoring_summary
from yieldwatch.operators.split import chrono_split
from yieldwatch.sources.scratch import settle
from yieldwatch.sources.writers import write_dashboard


@dataclass
class Dashboard:
    fact: DataFrame
    drift: DataFrame
    summary: DataFrame


def drift_report(features: DataFrame, keys: Sequence[str] = (), order: str = "date", method: str = "psi") -> DataFrame:
    """Drift of every column between the first 80 % of the dates and the rest."""
    names = [c for c in features.columns if c not in (order, *keys)]
    return feature_drift(chrono_split(features, keys, order), names, method=method)


def all_dashboards(
    predictions: DataFrame,
    features: DataFrame,
    window: int = 30,
    daily: bool = False,
    feature_keys: Sequence[str] = (),
    output: str | None = None,
    drift: DataFrame | None = None,
    mode: str = "error",
) -> Dashboard:
    """Fact table, drift report and summary of every (target, model) in `predictions`.

    Drift depends on the features only, so it is computed once for all of them; a report that
    is there already may be given as `drift`; `mode` is one of the writers'. A pair without predictions has no rows and so
    does not appear. Runs jobs that store the rolling errors, the scores and the drift.
    """
    fact, scores = monitoring_fact(predictions, window, daily)
    if drift is None:
        drift = settle(drift_report(features, feature_keys))
    summary = monitoring_summary(scores, drift)
    if output is not None:
        write_dashboard(fact, drift, summary, output, mode=mode)
    return Dashboard(fact, drift, summary)


def monitoring_dashboard(
    predictions: DataFrame,
    features: DataFrame,
    target: str,
    model: str,
    window: int = 30,
    daily: bool = False,
    feature_keys: Sequence[str] = (),
    output: str | None = None,
    drift: DataFrame | None = None,
    mode: str = "error",
) -> Dashboard:
    """The dashboard of one target and model."""
    own = predictions.filter((F.col("target") == target) & (F.col("model") == model))
    return all_dashboards(own, features, window, daily, feature_keys, output, drift, mode)
