"""Standard scaling with the population deviation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowwarden.operators.features import quoted


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mean, std) with the population standard deviation, from one pass over all columns."""
    stats = df.agg(
        *[F.avg(quoted(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(quoted(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
        for i, c in enumerate(cols)
    ]
    return stats.select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Scaler:
    """Fitted means and deviations; a constant column is only centred."""

    mean: dict[str, float]
    std: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> Scaler:
        rows = fit_scaler(df, cols).collect()  # one row per feature
        return cls({r["column"]: r["mean"] or 0.0 for r in rows}, {r["column"]: r["std"] or 0.0 for r in rows})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(
            *[
                ((quoted(c) - F.lit(self.mean[c])) / F.lit(self.std[c] or 1.0)).alias(c)
                if c in self.mean
                else quoted(c)
                for c in df.columns
            ]
        )
