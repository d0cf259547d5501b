"""Column alignment, cleaning and simple filters on flow tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.schema import (
    ATTACK_LABEL,
    BENIGN_LABEL,
    CANONICAL,
    FEATURE_MAP,
    FEATURES,
    IDENTITY,
    LABEL,
    REREAD,
    internal_name,
)


def quoted(name: str) -> Column:
    """Column by literal name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def align_features(df: DataFrame, keep: Sequence[str] = (), canonical: bool = False) -> DataFrame:
    """Flow-file columns -> the 79 training columns in model order, as one projection.

    A column the file lacks becomes 0, extra columns drop, one header length is read twice.
    `keep` names columns carried through unchanged; `canonical` uses the original names.
    """
    present = set(df.columns)
    projected = [quoted(k) for k in keep]
    for source, target in FEATURE_MAP:
        name = target if canonical else internal_name(target)
        real = REREAD.get(source, source)
        is_label = internal_name(target) == LABEL
        if real in present:
            value = quoted(real) if is_label else quoted(real).try_cast("double")
        else:
            value = F.lit("0") if is_label else F.lit(0.0)
        projected.append(value.alias(name))
    return df.select(*projected)


def validate_schema(df: DataFrame, expected: Sequence[str] = CANONICAL) -> list[tuple[int, str | None, str | None]]:
    """(place, expected name, found name) wherever the column names differ; empty if they agree (no job runs).

    A name that is missing at the end of either list is None.
    """
    pairs = zip_longest(expected, df.columns)
    return [(place, want, found) for place, (want, found) in enumerate(pairs) if want != found]


def feature_columns(df: DataFrame | None = None, label: str = LABEL) -> list[str]:
    """Feature names: every column but the label."""
    return list(FEATURES) if df is None else [c for c in df.columns if c.strip().lower() != label.strip().lower()]


def is_nonfinite(c: Column) -> Column:
    c = c.cast("double")
    return c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))


def clean_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Infinite, NaN and missing numbers become 0; other columns pass through."""
    wanted = set(cols)
    return df.select(
        *[
            F.when(is_nonfinite(quoted(c)), F.lit(0.0)).otherwise(quoted(c).cast("double")).alias(c)
            if c in wanted
            else quoted(c)
            for c in df.columns
        ]
    )


def nonfinite_count(df: DataFrame, cols: Sequence[str], per_column: bool = False) -> DataFrame:
    """Cells that cleaning would replace, in one pass: a total, or one row per column."""
    counts = df.agg(*[F.count_if(is_nonfinite(quoted(c))).alias(c) for c in cols])
    if per_column:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).alias("n")) for c in cols])
        return counts.select(F.inline(pairs))
    total = sum((quoted(c) for c in cols), F.lit(0).cast("bigint"))
    return counts.select(total.alias("nonfinite"))


def with_identity(df: DataFrame) -> DataFrame:
    """Replace the raw identity columns of a flow file by typed ones with their defaults.

    A missing or unreadable value takes the default; raw columns that are features stay as well.
    """
    present = set(df.columns)
    features = {source for source, _ in FEATURE_MAP}
    identity = {source for source, *_ in IDENTITY}
    typed = []
    for source, name, dtype, default in IDENTITY:
        fallback = F.lit(default).cast(dtype)
        value = F.coalesce(quoted(source).try_cast(dtype), fallback) if source in present else fallback
        typed.append(value.alias(name))
    others = [quoted(c) for c in df.columns if c in features or c not in identity]
    return df.select(*others, *typed)


def ssh_flows(df: DataFrame, port: int = 22, column: str = "dst_port") -> DataFrame:
    """Flows to one destination port; a table without that column passes through."""
    return df.filter(quoted(column) == port) if column in df.columns else df


def keep_labels(
    df: DataFrame, label: str = LABEL, labels: Sequence[str] = (ATTACK_LABEL, BENIGN_LABEL)
) -> DataFrame:
    return df.filter(quoted(label).isin(*labels))


def training_frame(
    df: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    attack: str = ATTACK_LABEL,
    benign: str = BENIGN_LABEL,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Two labels kept, a 0/1 target, and clean numeric features."""
    chosen = keep_labels(df, label, (attack, benign)).select(
        *[quoted(k) for k in keep],
        *[quoted(f).try_cast("double").alias(f) for f in features],
        (quoted(label) == attack).cast("int").alias("target"),
    )
    return clean_numeric(chosen, features)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Concatenate tables by column name; a column one side lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def side_by_side(*tables: DataFrame) -> DataFrame:
    """One-row tables with different columns -> one row with all of them, without a join."""
    stacked = union_by_name(*tables)
    return stacked.agg(*[F.max(quoted(c)).alias(c) for c in stacked.columns])
