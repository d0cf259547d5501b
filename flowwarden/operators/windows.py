"""File sequence and windows over files.

A window is a number of files, so it is built from the file table and from per-file partials:
each flow is read and scored once, and only the partials are replicated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.functions import scalars as S
from flowwarden.operators.detect import merge_partials, merge_targets, partials, targets


def file_sequence(files: DataFrame, file: str = "file") -> DataFrame:
    """Number distinct files 1, 2, ... by capture time, then name.

    Files are ranked inside their capture day; the days themselves (a calendar's worth of rows)
    give the offsets, so no task sees all files.  Files without a capture time come last.
    """
    started = S.capture_ts(file)
    day = F.coalesce(F.to_date(started), F.to_date(F.lit("9999-12-31")))
    dated = files.withColumn("capture_ts", started).withColumn("_day", day)
    per_day = dated.groupBy("_day").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_day.select("_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_day").orderBy(F.col("capture_ts").asc_nulls_last(), file))
    ranked = dated.withColumn("_rank", rank)
    numbered = ranked.join(F.broadcast(offsets), "_day")
    seq = (F.col("_before") + F.col("_rank")).cast("bigint")
    return numbered.select(*files.columns, "capture_ts", seq.alias("file_seq"))


def file_table(flows: DataFrame, files: DataFrame | None = None, file: str = "file") -> DataFrame:
    """One row per file: name, capture time, sequence number, flow count.

    `file` is whatever tells files apart, such as the full path; only windows show base names.

    Pass the listing as `files` where files without rows have to take a window slot.
    """
    counted = flows.groupBy(file).agg(F.count(F.lit(1)).alias("flow_count"))
    if files is not None:
        counted = (
            files.select(file)
            .distinct()
            .join(counted, file, "left")
            .select(file, F.coalesce("flow_count", F.lit(0)).cast("bigint").alias("flow_count"))
        )
    return file_sequence(counted, file)


def window_ids(mode: str, n: int, seq: str = "file_seq") -> Column:
    """Windows that hold a file: the next `n` for a rolling window, one for a fixed window."""
    s = F.col(seq)
    if mode == "rolling":
        return F.sequence(s, s + (n - 1))
    if mode == "fixed":
        return F.array(F.floor((s - 1) / n).cast("bigint") + 1)
    raise ValueError(f"window mode is 'rolling' or 'fixed', got {mode!r}")


def window_table(files: DataFrame, n: int, mode: str = "rolling", file: str = "file") -> DataFrame:
    """One row per window: its files in order, their number, all flows, and the newest capture time.

    A rolling window k ends with file k and exists from the first file on.
    """
    spread = files.withColumn("window_id", F.explode(window_ids(mode, n)))
    rows = F.array_sort(F.collect_list(F.struct("file_seq", file)))  # at most n files
    grouped = spread.groupBy("window_id").agg(
        F.transform(rows, lambda r: S.base_name(r[file])).alias("source_csvs"),
        F.count(F.lit(1)).alias("n_files"),
        F.sum("flow_count").alias("total_flows"),
        F.max("capture_ts").alias("window_ts"),
        F.max("file_seq").alias("last_seq"),
    )
    # A rolling window past the newest file does not exist.
    return grouped.filter(F.col("last_seq") == F.col("window_id")) if mode == "rolling" else grouped


def rolling_file_window(
    per_file: DataFrame, files: DataFrame, n: int, by: Sequence[str], mode: str = "rolling", file: str = "file"
) -> DataFrame:
    """Per-file partials -> partials per (window, key).  Windows past the newest file remain and
    are dropped by the join with the window table."""
    numbered = per_file.join(files.select(file, "file_seq"), file)
    spread = numbered.withColumn("window_id", F.explode(window_ids(mode, n)))
    return merge_partials(spread, ["window_id", *by])


def window_groups(
    found: DataFrame, files: DataFrame, n: int, mode: str = "rolling", ip: str = "src_ip", file: str = "file"
) -> DataFrame:
    """Hits -> partials per (window, attacker)."""
    return rolling_file_window(partials(found, [file, ip]), files, n, [ip], mode, file)


def fresh_attackers(groups: DataFrame, per_file: DataFrame, files: DataFrame, ip: str = "src_ip", file: str = "file") -> DataFrame:
    """Groups of rolling windows whose attacker has hits in the window's newest file.

    Without this, an attacker is reported by every window that still holds one of its files.
    """
    newest = per_file.join(files.select(file, "file_seq"), file).select(F.col("file_seq").alias("window_id"), ip)
    return groups.join(newest, ["window_id", ip], "left_semi")


def existing_windows(groups: DataFrame, windows: DataFrame) -> DataFrame:
    return groups.join(windows.select("window_id"), "window_id", "left_semi")


def window_targets(
    found: DataFrame, files: DataFrame, n: int, seen: str, mode: str = "rolling", ip: str = "src_ip", file: str = "file"
) -> DataFrame:
    """Targets per (window, attacker), counted from per-file counts.

    `seen` is the flow's position in its file; the first sighting is (file, position).
    """
    per_file = targets(found, [file, ip], seen)
    numbered = per_file.join(files.select(file, "file_seq"), file)
    placed = numbered.withColumn("first_seen", F.struct("file_seq", "first_seen"))
    spread = placed.withColumn("window_id", F.explode(window_ids(mode, n)))
    return merge_targets(spread, ["window_id", ip])


def flow_index(flows: DataFrame, files: DataFrame, n: int, mode: str = "rolling", file: str = "file") -> DataFrame:
    """Position of each flow in the concatenation of its window's files.

    `flows` carries `row_pos`, its 0-based position in the file; the rest is a prefix sum over
    the files of a window.
    """
    slots = files.withColumn("window_id", F.explode(window_ids(mode, n)))
    earlier = Window.partitionBy("window_id").orderBy("file_seq").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("flow_count").over(earlier), F.lit(0)).alias("_offset")
    last = F.max("file_seq").over(Window.partitionBy("window_id")).alias("_last")
    placed = slots.select(file, "window_id", offset, last)
    if mode == "rolling":
        placed = placed.filter(F.col("_last") == F.col("window_id"))
    joined = flows.join(placed.drop("_last"), file)
    return joined.withColumn("flow_index", F.col("_offset") + F.col("row_pos")).drop("_offset")


def time_windows(found: DataFrame, ts: str, width: str, slide: str | None = None, ip: str = "src_ip") -> DataFrame:
    """Attackers per window of time (the mode whose width is a duration, not a number of files)."""
    # A cast would hide the watermark of a stream, so only other types are cast.
    at = F.col(ts) if dict(found.dtypes)[ts] == "timestamp" else F.col(ts).cast("timestamp")
    slot = F.window(at, width, slide) if slide else F.window(at, width)
    return partials(found.withColumn("window", slot), ["window", ip])
