"""Landing CSV source.

Files are read by position with an explicit all-text schema (no
inference, header=false), lines with the wrong field count are dropped
(DROPMALFORMED), literal header rows are filtered by value, and each row
carries the URI of its file.

Two Spark specifics matter for exact results:

* CSV column pruning is switched off, otherwise a ``count(*)`` or a
  ``groupBy(file)`` parses no field and counts malformed lines too;
* quoting follows RFC 4180 (``""`` inside quotes), and ``multiLine`` is on
  by default so a quoted line break never splits a row. ``multiLine``
  makes each file one task. ``"auto"`` looks at the lines first: a quoted
  break leaves a line with an odd number of quotes before it, so a file all
  of whose lines have an even number is read in splits by several tasks,
  and only the others are read whole.
"""

from __future__ import annotations

import re
import urllib.parse
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Reader option (not a session setting: other CSV reads keep theirs).
PRUNING_OPTION = "columnPruning"
#: Spark's setting of the number of tasks that list the paths of a read.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Bytes of a landing file up to which it is looked through in one piece.
SMALL_FILE = 4 << 20
#: The fixed columns of Spark's binary file source.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


@contextmanager
def shared_listing(spark: SparkSession) -> Iterator[None]:
    """Reads made inside list their paths in a few tasks a core. Spark's
    default is a task a path (up to 10,000), which costs more than the
    reading where files are many and small."""
    old = spark.conf.get(LISTING_TASKS, None)
    spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(LISTING_TASKS)
        else:
            spark.conf.set(LISTING_TASKS, old)


def file_listing(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(URI, length, modification time) of the files matching a Hadoop glob,
    in order (metadata only; no content is read). Tasks list the files, so
    the driver asks nothing file by file, unless some of them are empty,
    which Spark's file sources pass over."""
    fs, p = _jvm_fs(spark, pattern)
    found = fs.globStatus(p)
    if found is None or not len(found):
        return []
    with shared_listing(spark):
        files = spark.read.format("binaryFile").schema(BINARY_FILE).load(pattern)
    rows = files.select("path", "length", F.unix_millis("modificationTime")).collect()
    if len(rows) == len(found):
        return sorted(map(tuple, rows))
    return sorted((str(s.getPath().toString()), int(s.getLen()), int(s.getModificationTime())) for s in found)


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """URIs of the files matching a Hadoop glob."""
    return [f[0] for f in file_listing(spark, pattern)]


def landing_has_files(spark: SparkSession, pattern: str) -> bool:
    fs, p = _jvm_fs(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def header_filter(header_cols: Sequence[str]) -> Column:
    """``NOT (c1 = 'c1' AND c2 = 'c2' ...)`` with SQL NULL logic: a row of
    all-NULL values yields NULL and is dropped too."""
    cond = None
    for c in header_cols:
        e = F.col(c) == F.lit(c)
        cond = e if cond is None else (cond & e)
    return ~cond


def file_name(source_file: Column | str) -> Column:
    c = F.col(source_file) if isinstance(source_file, str) else source_file
    return F.regexp_extract(c, r"([^/]*)$", 1)


def read_landing(spark: SparkSession, pattern: str | Sequence[str], columns: Sequence[str],
                 header_cols: Sequence[str] | None = None, multi_line: bool | str = True,
                 source_col: str = "source_file") -> DataFrame:
    """Rows of every file matching ``pattern`` (or of a list of files) plus
    ``source_col`` (file URI). An empty match or list gives a typed empty
    DataFrame instead of an error."""
    schema = text_schema(columns)
    if not (landing_has_files(spark, pattern) if isinstance(pattern, str) else pattern):
        empty = T.StructType(schema.fields + [T.StructField(source_col, T.StringType())])
        return spark.createDataFrame([], empty)
    if multi_line == "auto":
        files = list_files(spark, pattern) if isinstance(pattern, str) else list(pattern)
        whole = files_with_open_lines(spark, files)
        parts = [read_landing(spark, some, columns, header_cols, flag, source_col)
                 for some, flag in (([f for f in files if f not in whole], False), (sorted(whole), True)) if some]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    reader = (spark.read.schema(schema)
              .option(PRUNING_OPTION, "false")
              .option("header", "false")
              .option("mode", "DROPMALFORMED")
              .option("multiLine", str(multi_line).lower())
              .option("quote", '"')
              .option("escape", '"'))
    with shared_listing(spark):
        df = reader.csv(pattern if isinstance(pattern, str) else list(pattern))
    df = df.select(*columns, F.col("_metadata.file_path").alias(source_col))
    if header_cols:
        df = df.where(header_filter(header_cols))
    return df


def _odd_quotes(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def files_with_open_lines(spark: SparkSession, files: Sequence[str]) -> set[str]:
    """Those of ``files`` that have a line with an odd number of quotes
    (at most a name and a flag a file reach the driver). Small files are read
    in one piece each, which costs half of reading them line by line; the
    others in one scan in splits."""
    with shared_listing(spark):
        small = spark.read.format("binaryFile").schema(BINARY_FILE).load(list(files)).where(F.col("length") <= SMALL_FILE)
    text = F.decode("content", "ISO-8859-1")           # a character a byte: any content can be split
    # most files have no quote, and their lines are not looked at
    is_open = F.when(text.contains('"'), F.exists(F.split(text, "\r\n|[\r\n]"), _odd_quotes)).otherwise(False)
    seen = {_bare(r.path): r.is_open for r in small.select("path", is_open.alias("is_open")).collect()}
    large = [f for f in files if _bare(f) not in seen]
    plain = {f for f, found in seen.items() if found}
    if large:
        with shared_listing(spark):
            lines = spark.read.text(large)
        lines = lines.select("value", F.col("_metadata.file_path").alias("f"))
        plain |= {_bare(r.f) for r in lines.where(_odd_quotes(F.col("value"))).select("f").distinct().collect()}
    return {f for f in files if _bare(f) in plain}


def _bare(uri: str) -> str:
    """A URI as the listing and the scan both write it."""
    return re.sub(r"^file:/+", "/", urllib.parse.unquote(uri))


def new_files(df: DataFrame, audit: DataFrame | None, key: str = "source_file") -> DataFrame:
    """Rows of files not yet recorded in ``audit`` (NOT IN as left anti)."""
    if audit is None:
        return df
    return df.join(audit.select(key).where(F.col(key).isNotNull()), key, "left_anti")
