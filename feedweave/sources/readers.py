"""Sources."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed_values import FIELD_SEPARATOR
from ..session import stored
from .storage import Store


# Where the reader puts a line whose number of fields is not the header's.
RAW_LINE = "__raw_line"


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All columns as text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    sep: str = FIELD_SEPARATOR,
    quote: str | None = '"',
    glob: str | None = None,
    damaged: str | None = None,
) -> DataFrame:
    """Delimited text with a header; every column is text and nothing is inferred.

    ``quote=""`` turns quoting off, so that quotes are data. With ``columns``
    the schema is given and no file is opened for planning; the header must
    then list the columns in the same order.

    A line with more or fewer fields than the header reads shifted or cut. With ``damaged``, a column of
    this name holds such a line as it came, and null for all others; ``split_damaged`` parts the two.
    """
    paths = path if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("sep", sep).option("quote", quote or "")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if damaged is not None and columns is None:
        columns = reader.csv(paths).columns
    if columns is None:
        return reader.csv(paths)
    schema = text_schema(columns)
    if damaged is None:
        return reader.schema(schema).option("enforceSchema", False).csv(paths)
    # a pruned reader would not see how many fields a line has
    reader = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", RAW_LINE)
    rows = reader.schema(text_schema([*columns, RAW_LINE])).option("enforceSchema", False).csv(paths)
    # the reader refuses queries of the raw line alone, so the column also looks at a field
    line = F.concat(RAW_LINE, F.substring(F.coalesce(F.col(_quoted(columns[0])), F.lit("")), 1, 0))
    return rows.select(*[F.col(_quoted(c)) for c in columns], line.alias(damaged))


def split_damaged(rows: DataFrame, damaged: str) -> tuple[DataFrame, DataFrame]:
    """(the sound rows, the damaged lines with all columns that are not fields of the line)."""
    return rows.filter(F.col(damaged).isNull()).drop(damaged), rows.filter(F.col(damaged).isNotNull())


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


@dataclass(frozen=True)
class Landed:
    """Rows of landed files, and the landing paths that cannot be read because columns are missing."""

    rows: DataFrame | None
    unreadable: dict[str, list[str]]


def read_headers(spark: SparkSession, files: Sequence[str], sep: str = FIELD_SEPARATOR) -> dict[str, tuple[str, ...]]:
    """The header of each file (a coded URI): its first line alone is read, many files at a time, without a Spark job.

    Of the files with equal first lines one is opened by the reader, which names the columns.
    """
    lines = Store(spark).first_lines(files)
    # a file URI is coded, a path given to the reader is not
    named = {line: tuple(read_delimited(spark, unquote(file), sep=sep).columns) for line, file in {lines[f]: f for f in files}.items()}
    return {f: named[lines[f]] for f in files}


def read_landed(
    spark: SparkSession, landings: Sequence[str], columns: Sequence[str], path_column: str, damaged: str, sep: str = FIELD_SEPARATOR
) -> Landed:
    """Landed files or folders of files, each file read under its own header.

    Only the header lines are opened for planning. Files with equal headers are read together and checked
    against that header; the wanted columns are then picked by name. Every row carries its
    landing path, found by exact file URI (blanks and other coded characters included), and in
    ``damaged`` its line if that has more or fewer fields than its header.
    """
    store = Store(spark)
    owner = {file: landing for landing in landings for file in store.files(landing)}
    by_header: dict[tuple[str, ...], list[str]] = {}
    unreadable: dict[str, list[str]] = {}
    for file, header in read_headers(spark, list(owner), sep).items():
        missing = sorted({c.lower() for c in columns} - {c.lower() for c in header})
        if missing:
            unreadable.setdefault(owner[file], []).extend(missing)
        by_header.setdefault(header, []).append(file)
    parts = []
    for header, files in by_header.items():
        ready = [f for f in files if owner[f] not in unreadable]
        if ready:
            # a file URI is coded, a path given to the reader is not
            rows = read_delimited(spark, [unquote(f) for f in ready], header, sep, damaged=damaged)
            uri = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("__uri")
            parts.append(rows.select(*columns, damaged, uri))
    if not parts:
        return Landed(None, unreadable)
    # of rows from Python Spark knows no size, and would shuffle all landed rows to meet them
    owners = stored(spark.createDataFrame(list(owner.items()), "__file string, __landing string"), "owners")
    every = reduce(DataFrame.unionByName, parts).join(owners, F.col("__uri") == F.col("__file"), "left")
    lost = F.raise_error(F.concat(F.lit("rows of a file that no landing names: "), F.col("__uri")))
    landing = F.coalesce("__landing", lost.cast("string")).alias(path_column)
    return Landed(every.select(*columns, damaged, landing), unreadable)


def read_lookup(spark: SparkSession, path: str, keys: Sequence[str], sep: str = ",") -> DataFrame:
    """A comma-separated lookup: keys trimmed, empty keys dropped, one row per key.

    Of several rows with one key the least by the other columns stays.
    """
    raw = read_delimited(spark, path, sep=sep)
    trimmed = raw.withColumns({k: F.trim(F.col(k)) for k in keys}).na.drop(subset=list(keys))
    others = [c for c in trimmed.columns if c.lower() not in {k.lower() for k in keys}]
    if not others:
        return trimmed.select(*keys).distinct()
    least = F.min(F.struct(*others)).alias("__least")
    return trimmed.groupBy(*keys).agg(least).select(*keys, "__least.*")


def read_table(spark: SparkSession, path_or_name: str, fmt: str | None = None) -> DataFrame:
    """A stored table by path (in the session's default format unless given) or by catalog name."""
    if "/" not in path_or_name:
        return spark.table(path_or_name)
    return spark.read.load(path_or_name, format=fmt)


def file_listing(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Names and paths of the files in a folder. Only the listing is read, never the content."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return listed.select("path", F.substring_index("path", "/", -1).alias("file_name"))


def cohort_of(file_name: Column, tags: Sequence[str]) -> Column:
    """The first tag the file name contains, or null."""
    return F.coalesce(*[F.when(file_name.contains(t), F.lit(t)) for t in tags])


def cohort_status(spark: SparkSession, folder: str, tags: Sequence[str], glob: str = "*.dat") -> DataFrame:
    """One row per tag: number of files, status ``ok`` / ``missing`` / ``multiple``, the path if ok."""
    files = file_listing(spark, folder, glob)
    per_tag = [
        F.struct(
            F.lit(t).alias("cohort"),
            F.count_if(F.col("file_name").contains(t)).alias("files"),
            F.max(F.when(F.col("file_name").contains(t), F.col("path"))).alias("path"),
        )
        for t in tags
    ]
    rows = files.agg(F.array(*per_tag).alias("cohorts")).select(F.inline("cohorts"))
    status = F.when(F.col("files") == 1, "ok").when(F.col("files") == 0, "missing").otherwise("multiple")
    return rows.select(
        "cohort", "files", status.alias("status"), F.when(F.col("files") == 1, F.col("path")).alias("path")
    )


def read_cohorts(
    spark: SparkSession,
    folder: str,
    tags: Sequence[str],
    columns: Sequence[str] | None = None,
    glob: str = "*.dat",
    damaged: str | None = None,
) -> tuple[DataFrame | None, DataFrame]:
    """(rows of all cohorts that have exactly one file, with a ``cohort`` column; the status table).

    The data is None when no cohort is ready. At most one path per tag reaches the driver. ``damaged`` as in
    ``read_delimited``.
    """
    status = cohort_status(spark, folder, tags, glob)
    ready = [(r.cohort, r.path) for r in status.filter("status = 'ok'").collect()]
    if not ready:
        return None, status
    per_cohort = [
        read_delimited(spark, path, columns, quote="", damaged=damaged).withColumn("cohort", F.lit(cohort))
        for cohort, path in ready
    ]
    return reduce(DataFrame.unionByName, per_cohort), status
