"""Batch and stream sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.operators.features import quoted, with_identity
from flowwarden.schema import ALERT_SCHEMA, CANONICAL, INTERNAL, WHITELIST_ENTRY, raw_flow_schema
from flowwarden.sources.headers import FIRST_BYTES, first_lines, header_groups, parsed_lines

#: Alert documents, plain or compressed.
DOCUMENTS = "*.{json,json.gz}"


def _with_file(df: DataFrame) -> DataFrame:
    """The full path tells files apart; sensors may use the same base names."""
    return df.select("*", F.col("_metadata.file_path").alias("file"))


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a flow file (one line is read)."""
    first = spark.read.text(path).first()
    return [name for name in first["value"].split(",")] if first else []


def read_flows(
    spark: SparkSession,
    path: str,
    header: list[str] | None = None,
    glob: str = "*.csv",
    required: Sequence[str] = (),
    position: bool = False,
    unknown: str = "error",
) -> DataFrame:
    """Flow files as text columns, with typed identity columns and `file`, the full path.

    Columns are read as text and cast later: a numeric CSV schema would turn `inf` into null.  Each file is read by its
    own header, its first line, and columns are matched by name; a column that some files lack is null there.  A header
    without a known name is an error, or skipped with a warning (`unknown="skip"`).  With `header` all files must have
    that header, in that order, and no first lines are read; another one is an error.
    `required` columns must be in every file.  `position` adds `row_pos`, the 0-based place in the file.
    """
    if header is not None:
        groups = {tuple(header): [path]}
    else:
        groups = header_groups(spark, path, glob, unknown)
    for names in groups:
        if absent := set(required) - set(names):
            raise ValueError(f"files without the columns {sorted(absent)}: {groups[names][:3]}")
    parts = []
    for names, paths in sorted(groups.items()) or [((), [])]:
        if not paths:
            return with_identity(_empty(spark, position))
        # A header that was read from the files needs no check, and may be written with quotes or blanks.
        reader = spark.read.schema(raw_flow_schema(list(names))).option("header", True).option("enforceSchema", header is None)
        reader = reader.option("escape", '"')
        part = reader.option("pathGlobFilter", glob).csv(paths)
        parts.append(with_row_position(part) if position else _with_file(part))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return with_identity(out)


def _empty(spark: SparkSession, position: bool) -> DataFrame:
    fields = [*raw_flow_schema().fields, T.StructField("file", T.StringType())]
    return spark.createDataFrame([], T.StructType(fields + [T.StructField("row_pos", T.LongType())] * position))


def with_row_position(flows: DataFrame) -> DataFrame:
    """Add `file` (the full path) and `row_pos`, the 0-based position of a row in its file.

    Rows are ranked inside the file block they were read from, which bounds a group by the block
    size; the counts of a file's earlier blocks give the offset.  Call it right on the reader.
    """
    placed = flows.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    inside = Window.partitionBy("file", "_block")
    ranked = placed.withColumn("_rank", F.row_number().over(inside.orderBy("_row")))
    sizes = placed.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = ranked.join(offsets, ["file", "_block"])
    position = (F.col("_before") + F.col("_rank") - 1).alias("row_pos")
    return joined.select(*[quoted(c) for c in flows.columns], "file", position)


def read_labelled(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Labelled training files, all of which have to exist, concatenated.

    The header repeats a name, so columns are taken by position, and the header must be the known one.
    """
    schema = ", ".join(f"`{name}` string" for name in INTERNAL)
    parts = []
    for path in paths:
        try:
            part = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
        except AnalysisException as missing:
            raise FileNotFoundError(f"required training file not found: {path}") from missing
        if read_header(spark, path) != labelled_header():
            raise ValueError(f"the header of {path} is not that of a labelled training file")
        parts.append(part)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*[quoted(c).try_cast("double").alias(c) for c in INTERNAL[:-1]], INTERNAL[-1])


def labelled_header() -> list[str]:
    """Header names of a labelled training file."""
    return [c if c != " Fwd Header Length.1" else " Fwd Header Length" for c in CANONICAL]


def _documents() -> tuple[Column, Column]:
    """Lines of a whole text that are not blank, and whether each of them is a document."""
    lines = F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")
    return lines, F.forall(lines, lambda x: F.trim(x).startswith("{") & F.rtrim(x).endswith("}"))


def _alert_rows(docs: DataFrame, by_line: bool = False) -> DataFrame:
    """Alerts of JSON texts: one document a row with `by_line`, else whole files, indented or one document a line; bad texts give no row.

    A document that carries its own `alert_file` keeps it; else it is named after the file that holds it.
    """
    one = F.from_json("value", ALERT_SCHEMA)
    if by_line:
        doc = one
    else:
        lines, each_line = _documents()
        each = F.transform(lines, lambda x: F.from_json(x, ALERT_SCHEMA))
        doc = F.explode(F.when(each_line, each).otherwise(F.array(one)))
    docs = docs.select(doc.alias("doc"), F.col("_metadata.file_name").alias("_name"))
    named = F.coalesce("alert_file", "_name").alias("alert_file")
    rows = docs.select("doc.*", "_name").filter(F.coalesce("alert_id", "attacker_ip").isNotNull())
    return rows.select(*[c for c in ALERT_SCHEMA.names if c != "alert_file"], named)


def read_alerts(spark: SparkSession, path: str, glob: str = DOCUMENTS) -> DataFrame:
    """Alert documents with their `alert_file`: files hold one indented document, or one document a line.

    The beginning of each file tells which: an indented document starts with a line that is a brace only.  Files of lines
    are read by lines, plain ones in parts, so a file's size does not matter; an indented document is one row.
    """
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    listing = reader.format("binaryFile").load(path).select("path", "length").filter(F.col("length") > 0)
    # Beyond its first bytes a line is not looked at; a place that Arrow does not know is read whole.
    line = F.trim("line")
    kinds = first_lines(listing, FIRST_BYTES).select("path", F.coalesce((line != "{") & line.startswith("{"), F.lit(False)).alias("by_line"))
    paths: dict[bool, list[str]] = {True: [], False: []}
    for r in kinds.collect():
        paths[r["by_line"]].append(r["path"])
    parts = []
    if paths[True]:
        parts.append(_alert_rows(spark.read.text(paths[True]), by_line=True))
    if paths[False] or not parts:
        whole = spark.read.text(paths[False], wholetext=True) if paths[False] else reader.text(path, wholetext=True)
        parts.append(_alert_rows(whole))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a whitelist document, or of all documents in a folder; a missing file is an empty whitelist.

    A file holds one document, indented or not, or one document a line.
    """
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "entry string, reason string, added timestamp, added_by string")
    lines, by_line = _documents()
    each = text.select(F.explode(F.when(by_line, lines).otherwise(F.array("value"))).alias("value"))
    entries = each.select(F.explode(F.from_json("value", WHITELIST_ENTRY)).alias("entry", "about"))
    return entries.select(
        "entry",
        F.col("about.reason").alias("reason"),
        F.try_to_timestamp("about.added").alias("added"),
        F.col("about.added_by").alias("added_by"),
    )


def read_table(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """State, queue, history or counters; an absent table is empty."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def stream_flows(
    spark: SparkSession,
    path: str,
    header: list[str] | None = None,
    files_per_batch: int = 100,
    archive: str | None = None,
    glob: str = "*.csv",
    extra: Sequence[str] = (),
) -> DataFrame:
    """New flow files of a folder; files that are there at the first start are taken as well.

    Each file is read by its own header, its first line: columns of the flow format and those named in `extra` are
    matched by name, one that a file lacks is null, and a file without a known header is an error that names it.  The
    column `is_flow` is false in one row a file, which stands for the file itself, so a file without flows takes a
    window slot; a file without a byte does not exist for the stream.

    With `header` all files must have that header, in that order; its columns are all there are, and only files with
    rows are seen.
    """
    reader = spark.readStream.option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if header is None:
        names = [*raw_flow_schema().names, *extra]
        return with_identity(parsed_lines(_with_file(reader.text(path).select("value", "_metadata")), names))
    checked = reader.schema(raw_flow_schema(header)).option("header", True).option("enforceSchema", False).option("escape", '"')
    return with_identity(_with_file(checked.csv(path)))


def stream_alerts(
    spark: SparkSession, path: str, files_per_batch: int = 1000, archive: str | None = None, by_line: bool = False
) -> DataFrame:
    """New alert documents of a folder, in the formats that `read_alerts` takes.

    With `by_line` all files hold one document a line, and large ones are split unless they are compressed.
    """
    reader = (
        spark.readStream.format("text")
        .option("wholetext", not by_line)
        .option("pathGlobFilter", DOCUMENTS)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _alert_rows(reader.load(path), by_line)
