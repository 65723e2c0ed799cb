"""Source corpus scans and line explode.

A corpus is a DataFrame ``files(path string, content string)``. It can come from a folder of source
files (``scan_folder``), from any table with a path and a text column (``from_table``), or already as
lines ``lines(path, line, text)`` when the text was produced line by line (the generated corpora).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.materialize import stored
from ..functions.patterns import DEFAULT_EXTENSIONS

LINES_SCHEMA = "path string, line int, text string"


def decode(content: Column) -> Column:
    """UTF-8 when valid, else Latin-1 (every byte sequence is valid Latin-1)."""
    return F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8")) \
        .otherwise(F.decode(content, "ISO-8859-1"))


def scan_folder(spark: SparkSession, root: str, extensions: list[str] | None = DEFAULT_EXTENSIONS) -> DataFrame:
    """S1+S2+S4: read every file under ``root`` (recursive) whose extension is in ``extensions``."""
    # files of other extensions are left out when the folder is listed, so they are never opened
    df = _reader(spark, extensions).load(root).select(F.col("path"), decode(F.col("content")).alias("content"))
    return filter_extensions(df, extensions)


def listed(spark: SparkSession, root: str, extensions: list[str] | None = DEFAULT_EXTENSIONS) -> DataFrame:
    """S1+S2: path and bytes of the files under ``root``; none is opened."""
    return filter_extensions(_reader(spark, extensions).load(root).select("path", F.col("length").alias("bytes")), extensions)


def scan_checked(spark: SparkSession, root: str, extensions: list[str] | None = DEFAULT_EXTENSIONS,
                 max_bytes: int = 64 << 20) -> tuple[DataFrame, DataFrame]:
    """(files(path, content), errors(path, stage, error)): the readable files, and a row for each that is not: longer than
    ``max_bytes``, which is to fit a row (``scan_lines`` reads such files), or not readable. A bad file ends no task;
    what was listed and did not come is in the errors. Bytes that are no UTF-8 are Latin-1 and no error (S4)."""
    found = listed(spark, root, extensions)
    read = _reader(spark, extensions).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").load(root)
    files = filter_extensions(read.filter(F.col("length") <= max_bytes).select("path", decode(F.col("content")).alias("content")), extensions)
    files = stored(files, "files")
    long = found.filter(F.col("bytes") > max_bytes).select("path", F.format_string("%d bytes, more than %d", "bytes", F.lit(max_bytes)).alias("error"))
    lost = found.filter(F.col("bytes") <= max_bytes).join(files.select("path"), "path", "left_anti").select("path", F.lit("not readable").alias("error"))
    return files, long.unionByName(lost).select("path", F.lit("scan").alias("stage"), "error")


def scan_lines(spark: SparkSession, root: str, extensions: list[str] | None = DEFAULT_EXTENSIONS) -> DataFrame:
    """S1+S2+S4+T1 for files of any length: lines(path, line, text). The reader cuts long files into blocks and gives each
    block's lines in order; a line's number is its place in the block after the lines of the blocks before, of which
    only the counts meet. Terminators other than line feed and carriage return, which the reader does not know, cut its
    lines further (a file's last line keeps an empty end after one of those)."""
    reader = spark.read.format("text").option("recursiveFileLookup", "true")
    if extensions:
        reader = reader.option("pathGlobFilter", extension_glob(extensions))
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rows = reader.load(root).select(path.alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    rows = filter_extensions(rows, extensions)
    odd = rows.filter(~F.is_valid_utf8("value")).select("path").distinct().withColumn("odd", F.lit(True))
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    rows = rows.join(odd, "path", "left").select("path", "block", "at", F.split(F.when(F.col("odd"), latin).otherwise(F.col("value")), T.LINE_BREAK_RE).alias("parts"))
    rows = stored(rows.withColumn("more", F.size("parts") - 1), "file-lines")
    blocks = rows.groupBy("path", "block").agg(F.min("at").alias("first"), (F.count("*") + F.sum("more")).alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    blocks = blocks.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # lines that are cut further are few: each moves the later lines of its block
    moved = rows.filter("more > 0").groupBy("path", "block").agg(F.array_sort(F.collect_list(F.struct("at", "more"))).alias("moved"))
    met = rows.join(blocks.join(moved, ["path", "block"], "left"), ["path", "block"])
    shift = F.coalesce(F.aggregate(F.filter("moved", lambda x: x["at"] < F.col("at")), F.lit(0), lambda a, x: a + x["more"].cast("int")), F.lit(0))
    met = met.withColumn("line", F.col("base") + F.col("at") - F.col("first") + 1 + F.when(F.col("moved").isNotNull(), shift).otherwise(0))
    return met.select("path", "line", F.posexplode("parts").alias("nth", "text")).select("path", (F.col("line") + F.col("nth")).cast("int").alias("line"), "text")


def _reader(spark: SparkSession, extensions: list[str] | None):
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", extension_glob(extensions)) if extensions else reader


def extension_glob(extensions: list[str]) -> str:
    """A file-name glob for the extensions in any case: ``*.{[gG][qQ][lL]}``."""
    either = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e.lstrip(".")) for e in extensions]
    return "*.{" + ",".join(either) + "}"


def from_table(df: DataFrame, path_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("content"))


def filter_extensions(files: DataFrame, extensions: list[str] | None = DEFAULT_EXTENSIONS) -> DataFrame:
    """Keep files whose lower-case extension (no dot) is listed; ``None`` = language not
    configured -> no rows (same schema)."""
    if extensions is None:
        return files.limit(0)
    norm = [e.lstrip(".").lower() for e in extensions]
    return files.filter(T.extension(F.col("path")).isin(norm))


def split_lines(content: Column) -> Column:
    """Python splitlines semantics — split on every line terminator, no trailing empty piece."""
    parts = F.split(content, T.LINE_BREAK_RE)
    n = F.size(parts)
    return F.when(content.isNull() | (content == ""), F.array().cast("array<string>")) \
        .when(F.element_at(parts, -1) == "", F.slice(parts, 1, n - 1)) \
        .otherwise(parts)


def to_lines(files: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per (path, line) with 1-based line numbers."""
    keep = keep or []
    return files.select("path", *keep, F.posexplode(split_lines(F.col("content"))).alias("pos", "text")) \
        .select("path", *keep, (F.col("pos") + 1).cast("int").alias("line"), "text")


def file_line_counts(files: DataFrame) -> DataFrame:
    """Number of lines per file (0 for empty files), without exploding."""
    return files.select("path", F.size(split_lines(F.col("content"))).cast("int").alias("n_lines"))


def brace_counts(lines: DataFrame) -> DataFrame:
    """opens/closes per line."""
    return lines.withColumn("opens", T.count_char(F.col("text"), "{")) \
        .withColumn("closes", T.count_char(F.col("text"), "}"))
