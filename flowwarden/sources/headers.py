"""Flow files by their own header: first lines instead of a pass over the data, and lines parsed file by file.

A listing names the files without reading them; tasks then read one line of each.  Python workers reach
files through Arrow's file systems; what these do not know is read by Hadoop's, one line a file.
"""

from __future__ import annotations

import csv
import io
import warnings
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
import pyarrow.csv as pcsv
import pyarrow.fs as pfs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.schema import FEATURE_MAP, IDENTITY

KNOWN = frozenset({source for source, *_ in IDENTITY} | {source for source, _ in FEATURE_MAP})
MARK = "﻿"  # a byte order mark is no part of the first name
FIRST_BYTES = 1 << 16
OPEN_AT_ONCE = 16


def parse_header(line: str | None) -> list[str]:
    """Column names of a header line; quotes, outer blanks and a byte order mark go, a repeated name is numbered."""
    if not line:
        return []
    names: list[str] = []
    for name in next(csv.reader([line.removeprefix(MARK).rstrip("\r\n")]), []):
        name = plain = name.strip()
        again = 0
        while name in names:
            again += 1
            name = f"{plain} ({again + 1})"
        names.append(name)
    return names


def is_known(names: Sequence[str]) -> bool:
    return not KNOWN.isdisjoint(names)


def first_line(uri: str, most: int | None = None) -> str:
    """The first line of a file (or its first `most` bytes), without the rest; raises where no Arrow file system knows the place."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        system, at = pfs.LocalFileSystem(), parts.path
    else:
        system, at = pfs.FileSystem.from_uri(quote(uri, safe=":/@?&=%"))
    with system.open_input_stream(at) as stream:
        data = b""
        while b"\n" not in data and (most is None or len(data) < most) and (more := stream.read(FIRST_BYTES)):
            data += more
    return data.split(b"\n", 1)[0].decode("utf-8", "replace").removeprefix(MARK).rstrip("\r")


def _first_lines_by_hadoop(spark: SparkSession, paths: Sequence[str]) -> Iterator[str]:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def one(path: str) -> str:
        at = jvm.org.apache.hadoop.fs.Path(path)
        stream = at.getFileSystem(conf).open(at)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return (reader.readLine() or "").removeprefix(MARK)
        finally:
            stream.close()

    with ThreadPoolExecutor(OPEN_AT_ONCE) as pool:
        yield from pool.map(one, paths)


def first_lines(files: DataFrame, most: int | None = None) -> DataFrame:
    """(path, line) of a listing; a null line where no Arrow file system reads the place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, lines = batch.column(0).to_pylist(), []
            for path in paths:
                try:
                    lines.append(first_line(path, most))
                except FileNotFoundError:
                    raise
                except (OSError, pa.ArrowException):
                    lines.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lines, pa.string())], names=["path", "line"])

    # A scan has a task for each large file; these tasks only open them.
    few = 4 * files.sparkSession.sparkContext.defaultParallelism
    return files.select("path").coalesce(few).mapInArrow(run, "path string, line string")


def header_groups(spark: SparkSession, path: str, glob: str = "*.csv", unknown: str = "error") -> dict[tuple[str, ...], list[str]]:
    """Files by their header; only the first line of each is read.

    A file without a byte has no header and no rows.  A header without any name of the flow format is an error that
    names the files; with `unknown="skip"` they are left out with a warning.  Paths are collected, as every file source does.
    """
    if unknown not in ("error", "skip"):
        raise ValueError(f"unknown headers are an 'error' or 'skip', got {unknown!r}")
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")
    found = first_lines(listing.filter(F.col("length") > 0)).collect()
    far = [r["path"] for r in found if r["line"] is None]
    lines = {r["path"]: r["line"] for r in found} | dict(zip(far, _first_lines_by_hadoop(spark, far), strict=True))
    groups: dict[tuple[str, ...], list[str]] = {}
    strange = []
    for at, line in lines.items():
        names = tuple(parse_header(line))
        if is_known(names):
            groups.setdefault(names, []).append(at)
        else:
            strange.append(at)
    if strange:
        text = f"{len(strange)} files without a known header, such as {sorted(strange)[:3]}"
        if unknown == "error":
            raise ValueError(text)
        warnings.warn(text, stacklevel=3)
    return groups


class LineParser:
    """Lines of flow files to text columns, each file by its own first line."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self.heads: dict[str, tuple[str, list[str]]] = {}

    def head(self, path: str) -> tuple[str, list[str]]:
        if path not in self.heads:
            try:
                line = first_line(unquote(path))
            except (OSError, pa.ArrowException) as e:
                raise ValueError(f"cannot read the header of {path}; pass the header") from e
            names = parse_header(line)
            if not is_known(names):
                raise ValueError(f"{path} has no known header: {names[:5]}")
            self.heads[path] = (line, names)
        return self.heads[path]

    def parse(self, path: str, lines: list[str]) -> pa.RecordBatch:
        """The columns, the file, and `is_flow`: the header line is a row without values that is no flow."""
        header, names = self.head(path)
        at_start = lines.count(header) + lines.count(MARK + header)
        rows = [x for x in lines if x.strip() and x != header and x != MARK + header]
        table = self._table(rows, names)
        n = table.num_rows
        arrays = []
        for c in self.columns:
            value = table.column(c).combine_chunks() if c in names else pa.nulls(n, pa.string())
            if isinstance(value, pa.ChunkedArray):
                value = value.combine_chunks() if value.num_chunks else pa.nulls(0, pa.string())
            arrays.append(pa.concat_arrays([value.cast(pa.string()), pa.nulls(at_start, pa.string())]))
        arrays.append(pa.array([path] * (n + at_start), pa.string()))
        arrays.append(pa.array([True] * n + [False] * at_start))
        return pa.RecordBatch.from_arrays(arrays, names=[*self.columns, "file", "is_flow"])

    def _table(self, rows: list[str], names: list[str]) -> pa.Table:
        types = dict.fromkeys(names, pa.string())
        if not rows:
            return pa.table({n: pa.array([], t) for n, t in types.items()})
        ragged: list[str] = []

        def uneven(row: pcsv.InvalidRow) -> str:
            ragged.append(row.text)
            return "skip"

        def read(text: str, handler) -> pa.Table:
            return pcsv.read_csv(
                io.BytesIO(text.encode()),
                read_options=pcsv.ReadOptions(column_names=names, use_threads=False),
                parse_options=pcsv.ParseOptions(invalid_row_handler=handler),
                convert_options=pcsv.ConvertOptions(column_types=types, strings_can_be_null=True, null_values=[""]),
            )

        whole = read("\n".join(rows) + "\n", uneven)
        if not ragged:
            return whole
        # A short row is filled with nulls, a long one cut, as Spark's own reader does.
        fixed = [(r + [None] * len(names))[: len(names)] for r in csv.reader(ragged)]
        columns = {n: pa.array([r[i] or None for r in fixed], pa.string()) for i, n in enumerate(names)}
        return pa.concat_tables([whole, pa.table(columns)])


def parsed_lines(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(value, file) lines to text `columns`, `file` and `is_flow`; works on a stream as well.

    Columns are matched by name; one that a file lacks is null, one that is not asked for is dropped.  The header line
    of each file stays as one row that is no flow, so a file without flows can be told.
    """
    schema = T.StructType(
        [*[T.StructField(c, T.StringType()) for c in columns], T.StructField("file", T.StringType()), T.StructField("is_flow", T.BooleanType())]
    )
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = LineParser(names)
        for batch in batches:
            values, files = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(files):  # lines of a file follow each other
                end = at
                while end < len(files) and files[end] == files[at]:
                    end += 1
                yield parser.parse(files[at], values[at:end])
                at = end

    return lines.select("value", "file").mapInArrow(run, schema)
