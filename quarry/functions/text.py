"""Column-level text functions (T2-T12). All return Spark Columns; nothing runs in Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Line terminators recognised by Python's str.splitlines (CRLF first so it counts as one break).
LINE_BREAK_RE = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"


def count_char(col: Column, ch: str) -> Column:
    """Number of occurrences of one character (strings and comments are not excluded)."""
    return (F.length(col) - F.length(F.replace(col, F.lit(ch), F.lit("")))).cast("int")


def file_name(path: Column) -> Column:
    """Last path component."""
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def base_name(path: Column) -> Column:
    """File name without its last extension (a leading dot is not an extension)."""
    fn = file_name(path)
    return F.regexp_extract(fn, r"^(\.?[^.]*(?:\.[^.]+)*?)(?:\.[^.]*)?$", 1)


def extension(path: Column) -> Column:
    """Lower-case extension without the dot ('' if none)."""
    fn = file_name(path)
    return F.lower(F.regexp_extract(fn, r"^\.?[^.]*(?:\.[^.]+)*?(?:\.([^.]*))?$", 1))


def guid(obj_type: Column, path: Column, fullname: Column, start_line: Column) -> Column:
    """T5: type?[path with ? replaced by _].fullname@line."""
    return F.concat(obj_type, F.lit("?["), F.replace(path, F.lit("?"), F.lit("_")), F.lit("]."), fullname,
                    F.lit("@"), start_line.cast("string"))


def object_bookmark(path: Column, start_line: Column, end_line: Column) -> Column:
    """Object bookmark (start, 1, end + 1, 1); none when the start line is unknown."""
    return F.when(start_line > 0, F.struct(path.alias("path"), start_line.alias("line"), F.lit(1).alias("col"),
                                           (end_line + 1).alias("end_line"), F.lit(1).alias("end_col")))


def link_bookmark(path: Column, line: Column) -> Column:
    """Link bookmark (line, 1, line, -1); none when the line is unknown."""
    return F.when(line > 0, F.struct(path.alias("path"), line.alias("line"), F.lit(1).alias("col"),
                                     line.alias("end_line"), F.lit(-1).alias("end_col")))


def join_list(arr: Column) -> Column:
    """Stored form of a list property."""
    return F.array_join(arr, ", ")


def split_list(s: Column) -> Column:
    """Read a stored list property back."""
    return F.transform(F.split(s, ","), lambda x: F.trim(x))


def short_name(fullname: Column) -> Column:
    """Last '.' segment."""
    return F.substring_index(fullname, ".", -1)


#: More different depths than these are not told apart.
MOST_DEPTHS = 32


def _marks(c: Column, marks: str) -> Column:
    """Number of characters that are one of ``marks``."""
    return F.length(c) - F.length(F.translate(c, marks, ""))


def depths(df: DataFrame, name: Column, marks: str) -> list[int] | None:
    """The numbers of ``marks`` that names have; None if they are too many to be listed."""
    rows = df.select(_marks(name, marks).alias("n")).filter("n is not null").distinct().limit(MOST_DEPTHS + 1).collect()
    return sorted(r["n"] for r in rows) if len(rows) <= MOST_DEPTHS else None


def prefixes(fullname: Column, depths: list[int] | None = None) -> Column:
    """What stands before each '.' of a name; only prefixes of these numbers of dots, if ``depths`` are given."""
    if depths is None:
        parts = F.split(fullname, r"\.", -1)
        return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), ".")))
    n = _marks(fullname, ".")
    return F.array_compact(F.array(*[F.when(n > k, F.substring_index(fullname, ".", k + 1)) for k in depths]).cast("array<string>"))


def suffixes(fullname: Column, depths: list[int] | None = None) -> Column:
    """What follows each '.' or ':' of a name; only suffixes of these numbers of them, if ``depths`` are given."""
    if depths is None:
        parts = F.split(fullname, r"(?<=[.:])", -1)
        return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(2), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "")))
    n, dotted = _marks(fullname, ".:"), F.replace(fullname, F.lit(":"), F.lit("."))
    return F.array_compact(F.array(*[F.when(n > k, F.right(fullname, F.length(F.substring_index(dotted, ".", -k - 1)))) for k in depths]).cast("array<string>"))


def last_segment(name: Column) -> Column:
    """What follows the last '.' or ':'."""
    return F.substring_index(F.replace(name, F.lit(":"), F.lit(".")), ".", -1)


def parent_simple_name(fullname: Column) -> Column:
    """Second-last '.' segment, null when there is no dot."""
    return F.when(F.instr(fullname, ".") > 0, F.try_element_at(F.split(fullname, r"\."), F.lit(-2)))


def has_annotation(annotations: Column, marker: str) -> Column:
    """Any annotation contains the marker (substring test); null list -> false."""
    return F.coalesce(F.exists(annotations, lambda a: F.contains(a, F.lit(marker))), F.lit(False))


def unmatched_braces(text: Column) -> Column:
    """struct(closes, opens): the braces of a line that have no partner on it, as in ``} else {``."""
    opens, closes = count_char(text, "{"), count_char(text, "}")
    walk = F.aggregate(
        F.split(F.regexp_replace(text, "[^{}]", ""), ""), F.struct(F.lit(0).alias("d"), F.lit(0).alias("low")),
        lambda a, c: F.struct((a["d"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)).alias("d"),
                              F.least(a["low"], a["d"] + F.when(c == "}", -1).otherwise(0)).alias("low")),
        lambda a: F.struct((-a["low"]).alias("closes"), (a["d"] - a["low"]).alias("opens")))
    zero = F.lit(0)
    return F.when(closes == 0, F.struct(zero.alias("closes"), opens.cast("int").alias("opens"))) \
        .when(opens == 0, F.struct(closes.cast("int").alias("closes"), zero.alias("opens"))).otherwise(walk)


def strip_ws(c: Column) -> Column:
    """Python str.strip(): remove surrounding whitespace (ASCII, see D24). Before a line terminator that is not ASCII, which
    ends a text for the regex, whitespace goes too."""
    odd = c.endswith("\u0085") | c.endswith("\u2028") | c.endswith("\u2029")
    return F.when(odd, F.regexp_replace(c, r"^\s+|\s+$", "")).otherwise(F.btrim(c, F.lit(" \t\n\x0b\f\r")))


def clean_template(text: Column) -> Column:
    """Strip backticks then surrounding whitespace (no cut at the first tab: decision D12)."""
    return strip_ws(F.when(text.contains("`"), F.regexp_replace(text, r"^`+|`+$", "")).otherwise(text))


def clean_option(value: Column) -> Column:
    """Strip double then single quotes; empty -> null."""
    return nullif_empty(F.regexp_replace(F.regexp_replace(value, r'^"+|"+$', ""), r"^'+|'+$", ""))


def nullif_empty(c: Column) -> Column:
    return F.when(c != "", c)  # not nullif(): its shared-expression nodes make large plans slow to analyse


# T4 (dead in the analysed tool, offered as an operator): scanner tokens in scanner order. A token is
# a '#' comment to the end of the line, a /* */ comment, a triple-quoted string (may span lines), a
# quoted string with backslash escapes ending at its quote or at the end of the line, or plain text.
# Possessive runs keep the matcher's stack flat however long a literal is.
MASK_TOKEN_RE = (r"(?s)#[^\n]*|/\*.*?(?:\*/|$)|\"\"\".*?(?:\"\"\"|$)|'\'\'.*?(?:'\'\'|$)"
                 r"|\"[^\"\\\n]*+(?:\\[^\n][^\"\\\n]*+)*+\"?|'[^'\\\n]*+(?:\\[^\n][^'\\\n]*+)*+'?|[^#/\"']++|.")


def mask_source(text: Column) -> Column:
    """T4: strings and comments replaced by spaces of the same length; newlines are kept (D10 fix)."""
    toks = F.regexp_extract_all(text, F.lit(MASK_TOKEN_RE), 0)
    masked = F.transform(toks, lambda t: F.when(t.rlike("^(#|/\\*|\"|')"), F.regexp_replace(t, "[^\n]", " "))
                         .otherwise(t))
    return F.array_join(masked, "")
