"""CSV extracts: tolerant reading into one typed table, and reports on what was wrong with them."""

from __future__ import annotations

import csv as csv_module
import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ontime.functions.values import convert
from ontime.operators.clean import constant_table, union_by_name
from ontime.schema import RAW
from ontime.session import FOLDERS, WIDE_STAGES, settings

BAD = "_malformed"
PATTERN = "*.csv"


def list_files(spark: SparkSession, path: str, pattern: str = PATTERN) -> DataFrame:
    """Path and size of every matching file below a folder. Contents are not read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return listing.load(path).select("path", F.col("length").alias("bytes"))


def _reader(spark: SparkSession, pattern: str = PATTERN):
    """Quotes inside quoted cells are doubled, as every usual writer does."""
    return spark.read.option("header", True).option("pathGlobFilter", pattern).option("quote", '"').option("escape", '"')


# Every split is a task of its own, so that a task's first row is the first line of its split.
_ONE_SPLIT = {"spark.sql.files.openCostInBytes": "1t"}
#: The part of monotonically_increasing_id that counts the rows of a task.
_ROW_OF_TASK = (1 << 33) - 1


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line of every file that has one, by plain path. Tasks read no more than a split of a file and keep single lines;
    the driver gets only them."""
    with settings(spark, _ONE_SPLIT):
        lines = spark.read.option("ignoreCorruptFiles", True).text(paths)
        at = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_OF_TASK))
        named = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), at.alias("row"), "value")
        found = named.where("start = 0 AND row = 0").select("path", "value").collect()
    return {plain(r.path): r.value for r in found}


def headers(spark: SparkSession, paths: list[str]) -> list[tuple[str, list[str] | None, str | None]]:
    """(path, header, reason) of every file: the cells of its first line, or why they can't be read.

    Tasks read the lines. Only files that gave none are opened from here, to learn the reason.
    """
    lines = first_lines(spark, paths) if paths else {}
    found = []
    for path in paths:
        line, reason = (lines[plain(path)], None) if plain(path) in lines else _opened(spark, path)
        if line:
            found.append((path, next(csv_module.reader([line.removeprefix("\ufeff")])), None))
        else:
            found.append((path, None, reason or "no header line"))
    return found


def _opened(spark: SparkSession, path: str) -> tuple[str | None, str | None]:
    """First line of one file or why there is none, through Spark's own file systems."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    try:
        place = jvm.org.apache.hadoop.fs.Path(path)
        stream = place.getFileSystem(conf).open(place)
        try:
            codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
            text = codec.createInputStream(stream) if codec else stream
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine(), None
        finally:
            stream.close()
    except Exception as error:  # the reason is part of the report
        cause = getattr(error, "java_exception", None)
        return None, str(cause.toString() if cause else error).splitlines()[0]


def by_header(
    spark: SparkSession, files: list[str], skip_unreadable: bool = False, found: list[tuple[str, list[str] | None, str | None]] | None = None
) -> dict[tuple[str, ...], list[str]]:
    """Files by their header. One without a header line has no rows; one that can't be read is an error unless it may be skipped.

    ``found`` is what ``headers`` gave for these files, where that is known already.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header, reason in headers(spark, files) if found is None else found:
        if header is not None:
            groups.setdefault(tuple(header), []).append(file)
        elif reason != "no header line" and not skip_unreadable:
            raise ValueError(f"{file}: {reason}")
    return groups


def _scan(
    spark: SparkSession, paths: str | list[str], header: list[str], base: str | None, pattern: str, has_header: bool, skip_unreadable: bool, multi_line: bool, file_column: str | None
) -> DataFrame:
    layout = T.StructType([T.StructField(c, T.StringType()) for c in header + [BAD]])
    reader = (
        _reader(spark, pattern)
        .option("header", has_header)
        .schema(layout)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD)
        .option("columnPruning", False)  # a row's cells can only be counted when all are parsed
        .option("ignoreCorruptFiles", skip_unreadable)
        .option("multiLine", multi_line)
    )
    rows = (reader.option("basePath", base) if base else reader).csv(paths)
    return rows.withColumn(file_column, F.col("_metadata.file_path")) if file_column else rows


def read_groups(
    spark: SparkSession, groups: dict[tuple[str, ...], list[str]], base: str | None = None, pattern: str = PATTERN, skip_unreadable: bool = False,
    multi_line: bool = False, file_column: str | None = None,
) -> DataFrame:
    """The files of each header as one scan, columns matched by name."""
    scans = [_scan(spark, paths, list(header), base, pattern, True, skip_unreadable, multi_line, file_column) for header, paths in sorted(groups.items())]
    return union_by_name(scans)


def read_text(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    pattern: str = PATTERN,
    skip_unreadable: bool = False,
    multi_line: bool = False,
    file_column: str | None = None,
    found: list[tuple[str, list[str] | None, str | None]] | None = None,
) -> DataFrame:
    """One CSV data set (a file, or a folder of files) with every column as text.

    Files of one folder may differ in their headers: each distinct header is one scan, and columns are matched by name; one that a
    file lacks is null there. ``columns`` names the cells of files that have no header line.

    Rows with too few or too many cells stay, with the original line in ``_malformed``. A file without a readable header is an
    error; with ``skip_unreadable`` it is left out instead, and ``file_report`` lists it with the reason. ``multi_line`` allows
    line breaks inside quoted cells; such files can't be split over tasks, so it is off by default. ``file_column`` adds each row's file
    under that name. ``found`` is what ``headers`` gave for the files, where that is known already.
    """
    files = [r.path for r in list_files(spark, path, pattern).select("path").collect()] if found is None else [f for f, _, _ in found]
    if not files:
        raise ValueError(f"no CSV files in {path}")
    if columns is not None:
        return _scan(spark, path, columns, None, pattern, False, skip_unreadable, multi_line, file_column)
    groups = by_header(spark, files, skip_unreadable, found)
    if not groups:
        raise ValueError(f"no readable CSV files in {path}")
    single = path.rstrip("/").rsplit("/", 1)[-1] == files[0].rsplit("/", 1)[-1]
    whole = len(groups) == 1 and len(files) == sum(map(len, groups.values()))
    if whole or single:
        return _scan(spark, path, list(next(iter(groups))), None, pattern, True, skip_unreadable, multi_line, file_column)
    return read_groups(spark, groups, path, pattern, skip_unreadable, multi_line, file_column)


def typed(df: DataFrame, layout: T.StructType = RAW, keep: list[str] | None = None) -> DataFrame:
    """Text columns to the layout's types, by name. Columns outside the layout go, absent ones are null."""
    columns = [
        (convert(f"`{f.name}`", f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in layout.fields
    ]
    return df.select(*(keep or []), *columns)


def ingest(
    spark: SparkSession,
    paths: list[str],
    layout: T.StructType = RAW,
    skip_unreadable: bool = False,
    on_malformed: str = "keep",
    multi_line: bool = False,
) -> DataFrame:
    """Several CSV data sets, one per year say, as one typed table; headers may differ between and inside them.

    ``on_malformed`` says what becomes of rows with too few or too many cells: "keep" takes the cells that are there, "drop"
    leaves such rows out, "fail" stops on the first; "mark" keeps them with the original line in a last column ``_malformed``.
    """
    if not paths:
        raise ValueError("no input paths")
    if on_malformed not in ("keep", "drop", "fail", "mark"):
        raise ValueError(f"unknown choice {on_malformed!r}")
    parts = []
    for p in paths:
        text = read_text(spark, p, skip_unreadable=skip_unreadable, multi_line=multi_line)
        if on_malformed == "drop":
            text = text.filter(F.col(BAD).isNull())
        elif on_malformed == "fail":
            stop = F.raise_error(F.concat(F.lit("malformed row: "), F.col(BAD))).cast("boolean")
            text = text.filter(F.when(F.col(BAD).isNull(), True).otherwise(stop))
        rows = typed(text, layout, [BAD] if on_malformed == "mark" else None)
        parts.append(rows.select(*layout.names, BAD) if on_malformed == "mark" else rows)
    return union_by_name(parts)


def require_rows(df: DataFrame) -> DataFrame:
    """The table itself, or an error when nothing was read; stops at the first row."""
    if df.isEmpty():
        raise ValueError("no valid rows were read")
    return df


def infer(spark: SparkSession, path: str, sampled: float = 1.0, multi_line: bool = False) -> DataFrame:
    """Read with guessed types; ``sampled`` below 1 guesses from that part of the rows."""
    return _reader(spark).option("inferSchema", True).option("samplingRatio", sampled).option("multiLine", multi_line).csv(path)


def rows_per_file(df: DataFrame, files: DataFrame | None = None, file_column: str = "_metadata.file_path") -> DataFrame:
    """Rows read from each file; with a listing, files that gave no rows are there with 0."""
    counts = df.select(F.col(file_column).alias("path")).groupBy("path").agg(F.count("*").alias("n"))
    if files is None:
        return counts
    listed = files.select(plain_path("path").alias("path"))
    counts = counts.withColumn("path", plain_path("path"))
    return listed.join(counts, "path", "left").fillna(0, ["n"])


def file_report(spark: SparkSession, path: str, pattern: str = PATTERN) -> DataFrame:
    """Per file: rows, malformed rows, and why it could not be read, if so; unreadable files have 0 rows."""
    files = list_files(spark, path, pattern)
    found = headers(spark, [r.path for r in files.select("path").collect()])
    outcome = constant_table(spark, [(f, reason) for f, _, reason in found], ["path", "reason"], ["string", "string"])
    outcome = outcome.withColumn("path", plain_path("path"))
    if all(header is None for _, header, _ in found):
        counts = outcome.limit(0).select("path", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("n_malformed"))
    else:
        text = read_text(spark, path, pattern=pattern, skip_unreadable=True, file_column="_file", found=found)
        # Spark refuses to read the mark alone, so a cell of the row is read with it.
        marked = F.when(F.col(BAD).isNotNull(), F.struct(text.columns[0]))
        counts = text.groupBy(F.col("_file").alias("path")).agg(F.count("*").alias("n"), F.count(marked).alias("n_malformed"))
        counts = counts.select(plain_path("path").alias("path"), "n", "n_malformed")
    return outcome.join(counts, "path", "left").fillna(0, ["n", "n_malformed"]).select("path", "n", "n_malformed", "reason")


_SCHEME = "^([a-z0-9]+):/+"


def plain_path(column: str):
    """A path without the slashes that differ between file listings (file:/a and file:///a)."""
    return F.regexp_replace(F.col(column), _SCHEME, "$1:/")


def plain(path: str) -> str:
    """The same for a single path."""
    return re.sub(_SCHEME, r"\1:/", path)


def dataset_of(column: str = "_metadata.file_path"):
    """The name of the folder a file lies in."""
    return F.element_at(F.split(F.col(column), "/"), -2)


def row_report(df: DataFrame, file_column: str = "_metadata.file_path") -> DataFrame:
    """Per folder: rows read by ``read_text``, how many were malformed, and how many lack their first cell."""
    return df.groupBy(dataset_of(file_column).alias("dataset")).agg(
        F.count("*").alias("n"),
        F.count(BAD).alias("n_malformed"),
        F.count_if(F.col(df.columns[0]).isNull()).alias("n_no_first_cell"),
    )


def write(df: DataFrame, path: str, by: list[str] | None = None, one_file: bool = False, multi_line: bool = False, mode: str = "overwrite") -> None:
    """Write with a header. ``one_file`` forces everything through a single task; only for small tables.

    A cell with a line break would come back as two rows unless it is read with ``multi_line``, so without that it is an error.
    """
    if not multi_line:
        stop = F.raise_error(F.lit("a cell holds a line break; write and read with multi_line")).cast("string")
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({c: F.when(F.col(f"`{c}`").rlike("[\r\n]"), stop).otherwise(F.col(f"`{c}`")) for c in texts}) if texts else df
    out = (df.coalesce(1) if one_file else df).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
    with settings(df.sparkSession, WIDE_STAGES | FOLDERS):
        (out.partitionBy(*by) if by else out).csv(path)
