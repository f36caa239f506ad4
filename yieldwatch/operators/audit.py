"""Look-ahead audit: do rows before a date change when later rows are taken away?"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookahead_audit(
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    until: datetime.date,
    keys: Sequence[str] = ("series_id",),
    order: str = "date",
) -> DataFrame:
    """Run `build` on all rows and on the rows up to `until`, and compare up to `until`.

    One row per output column: rows compared, rows that differ, and `uses_future`. A row
    that exists in only one run counts as a difference in every column. Rows with a NULL key
    are compared with those of the same NULL key.
    """
    key_columns = [*keys, order]
    full = build(source).filter(F.col(order) <= F.lit(until))
    short = build(source.filter(F.col(order) <= F.lit(until))).filter(F.col(order) <= F.lit(until))
    features = [c for c in full.columns if c not in key_columns]
    left = full.select(*key_columns, F.struct(*features).alias("_full"))
    right = short.select(*[F.col(c).alias(f"_key_{i}") for i, c in enumerate(key_columns)], F.struct(*features).alias("_short"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_key_{i}")) for i, c in enumerate(key_columns)])
    both = left.join(right, same, "full_outer")
    one_sided = F.col("_full").isNull() | F.col("_short").isNull()

    def changed(c: str):
        return one_sided | ~F.col("_full")[c].eqNullSafe(F.col("_short")[c])

    report = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.count(F.lit(1)).alias("rows_compared"),
                F.count_if(changed(c)).alias("rows_changed"),
            )
            for c in features
        ]
    )
    return both.agg(report.alias("_r")).select(F.inline("_r")).withColumn(
        "uses_future", F.col("rows_changed") > 0
    )
