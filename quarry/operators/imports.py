"""Import extraction.

Per line, the first of seven patterns that finds a match wins. Lines inside a ``import ( … )`` block
header/closer pair are handled with a running "inside block" flag: the last header or closer seen
before the line (a chunked as-of lookup, so one long file spreads over tasks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.prefix import asof_last

# FIXED VALUES: import patterns in priority order (searched anywhere in the line; '^' anchors).
IMPORT_PATTERNS = [
    r"^\s*from\s+([a-zA-Z_][\w.]*)\s+import\s+([a-zA-Z_][\w,\s*]*)",
    r"^\s*import\s+([a-zA-Z_][\w.]*)",
    r"^\s*import\s+\{([^}]+)\}\s+from\s+['\"]([^\"']+)['\"]",
    r"^\s*import\s+([a-zA-Z_][\w]*)\s+from\s+['\"]([^\"']+)['\"]",
    r"\brequire\s*\(\s*['\"]([^\"']+)['\"]\s*\)",
    r"^\s*import\s+['\"]([^\"']+)['\"]",
    r"^\s*['\"]([^\"']+)['\"]",
]
_TWO_GROUPS = {0, 2, 3}


def telling(txt: Column) -> Column:
    """Only lines that can match a pattern or mark a block take part (every pattern needs 'import',
    'require' or a leading quote); the per-file window then sees a small fraction of the lines."""
    return txt.contains("import") | txt.contains("require") | txt.rlike(r"^\s*['\"]") | (T.strip_ws(txt) == ")")


def extract_imports(lines: DataFrame) -> DataFrame:
    """imports(path, line, name, source, statement) in statement order."""
    txt = F.col("text")
    lines = lines.filter(telling(txt))
    stripped = T.strip_ws(txt)  # Python str.strip(): all surrounding whitespace
    header = stripped.startswith("import (")
    closer = stripped == ")"
    mark = F.when(header, F.lit(1)).when(closer, F.lit(0))
    asked = lines.withColumn("__kind", F.lit(0)).withColumn("__mark", F.lit(None).cast("int"))
    told = lines.withColumn("__kind", F.lit(1)).withColumn("__mark", mark).filter("__mark is not null")
    seen = asof_last(asked.unionByName(told), ["path"], "line", "__kind", "__mark", "__last").filter("__kind = 0")
    marks = seen.withColumn("__in_block", F.coalesce("__last", F.lit(0)) == 1)
    # a header line is skipped; a closer line is skipped only while inside a block
    skip = header | (F.col("__in_block") & closer)
    which = F.coalesce(*[F.when(txt.rlike(p), F.lit(i)) for i, p in enumerate(IMPORT_PATTERNS)])
    m = marks.filter(~skip).withColumn("__k", which).filter(F.col("__k").isNotNull())
    g1 = F.coalesce(*[F.when(F.col("__k") == i, F.regexp_extract(txt, p, 1)) for i, p in enumerate(IMPORT_PATTERNS)])
    g2 = F.coalesce(*[F.when(F.col("__k") == i, F.regexp_extract(txt, p, 2))
                      for i, p in enumerate(IMPORT_PATTERNS) if i in _TWO_GROUPS])
    two = F.col("__k").isin(*_TWO_GROUPS)
    m = m.select("path", "line", txt.alias("statement"), two.alias("two"), g1.alias("g1"), g2.alias("g2"))
    # Two captures -> names split on [,\s]+, '*' stripped, empty and 'as' dropped
    multi = m.filter("two").select("path", "line", "statement", F.posexplode(F.split(F.col("g1"), r"[,\s]+")).alias("k", "raw"),
                                   F.col("g2").alias("source"))
    multi = multi.withColumn("name", F.regexp_replace(F.trim(F.col("raw")), r"^\*+|\*+$", "")) \
        .filter((F.col("name") != "") & (F.col("name") != "as")).drop("raw")
    # One capture -> short name = last part after '.', then after '/'
    single = m.filter(~F.col("two")).select(
        "path", "line", "statement", F.lit(0).alias("k"),
        F.substring_index(F.substring_index(F.col("g1"), ".", -1), "/", -1).alias("name"), F.col("g1").alias("source"))
    return multi.unionByName(single).select("path", "line", "k", "name", "source", "statement")


def import_map(imps: DataFrame) -> DataFrame:
    """I4: name -> source per file, last statement wins."""
    return imps.groupBy("path", "name").agg(F.max_by("source", F.struct("line", "k")).alias("source"))
