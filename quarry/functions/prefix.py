"""Skew-safe running sums.

A running sum over ``Window.partitionBy(key).orderBy(pos)`` puts a whole key in one task. When one
file (or one supplier) holds a large share of all rows that task dominates the job. ``running_sums``
splits such a key into chunks of ``chunk_rows`` positions: totals per chunk are summed with a window over
the (much smaller) chunk table, and the final sum is the chunk offset plus a window inside the chunk.
Both windows are bounded by ``chunk_rows`` rows or by ``rows / chunk_rows`` rows per key. Keys with few rows are one
chunk each: they need no totals and no offsets, whatever their positions are. Which keys have many rows is
counted before, in ``BUCKETS`` buckets of hashed keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .materialize import stored

DEFAULT_CHUNK = 1 << 16
#: Hashed keys are counted in so many buckets; the keys of one that has a chunk's number of rows are split into chunks.
BUCKETS = 1 << 16


def _chunks(df: DataFrame, keys: list[str], pos: str, chunk_rows: int, plain: DataFrame | None) -> tuple[Column, Column, Column | None]:
    """(the chunk of a row, whether it has a place at all, whether its key is split; the last is None where no key is).
    Rows with a null key or position have no place: they meet only the rows of their own chunk."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("__bucket")
    counts = (df if plain is None else plain).groupBy(bucket).agg(F.count("*").alias("__n")).filter(F.col("__n") >= chunk_rows)
    full = [r["__bucket"] for r in counts.collect()]  # at most BUCKETS
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    split = bucket.isin(full) if full else None
    apart = ~keyed if split is None else ~keyed | split
    chunk = F.when(apart, F.floor(F.col(pos) / F.lit(chunk_rows))).when(F.col(pos).isNotNull(), F.lit(0).cast("long"))
    return chunk, keyed & F.col(pos).isNotNull(), split


def running_sums(df: DataFrame, keys: list[str], pos: str, values: dict[str, Column | str], chunk_rows: int = DEFAULT_CHUNK,
                 inclusive: bool = True, plain: DataFrame | None = None) -> DataFrame:
    """Add a column for each of ``values`` = its sum over rows with the same ``keys`` and position <= pos
    (or < pos when ``inclusive`` is False). ``pos`` must be an integer column, unique per key. ``plain``: the same rows
    with ``keys``, ``pos`` and what the values read, for counts and totals in place of ``df``, where that is costly to compute."""
    chunk = "__chunk"
    at, placed, split = _chunks(df, keys, pos, chunk_rows, plain)
    tmp = {out: f"__val{i}" for i, out in enumerate(values)}
    added = {tmp[out]: (F.col(v) if isinstance(v, str) else v).cast("long") for out, v in values.items()}
    d = df.withColumns({**added, chunk: at, "__placed": placed})
    frame_end = 0 if inclusive else -1
    w_in = Window.partitionBy(*keys, chunk).orderBy(pos).rowsBetween(Window.unboundedPreceding, frame_end)
    local = {out: F.coalesce(F.sum(t).over(w_in), F.lit(0)) for out, t in tmp.items()}
    dropped = [chunk, "__placed", *tmp.values()]
    if split is None:
        return d.withColumns({out: F.when(F.col("__placed"), x).cast("long") for out, x in local.items()}).drop(*dropped)
    d = d.withColumn("__split", split).withColumns({f"{t}l": local[out] for out, t in tmp.items()})
    totals = (df if plain is None else plain).filter(split).withColumns({**added, chunk: at})
    totals = totals.groupBy(*keys, chunk).agg(*[F.sum(t).alias(f"{t}t") for t in tmp.values()])
    w_chunks = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, chunk, *[F.coalesce(F.sum(f"{t}t").over(w_chunks), F.lit(0)).alias(f"{t}o") for t in tmp.values()])
    d = d.join(offsets, on=[*keys, chunk], how="left")
    before = {t: F.when(F.col("__split"), F.col(f"{t}o")).otherwise(0) for t in tmp.values()}
    sums = {out: F.when(F.col("__placed"), before[t] + F.col(f"{t}l")).cast("long") for out, t in tmp.items()}
    return d.withColumns(sums).drop("__split", *dropped, *[f"{t}{x}" for t in tmp.values() for x in "lo"])


def running_sum(df: DataFrame, keys: list[str], pos: str, value: Column | str, out: str,
                chunk_rows: int = DEFAULT_CHUNK, inclusive: bool = True, plain: DataFrame | None = None) -> DataFrame:
    """``running_sums`` of one value."""
    return running_sums(df, keys, pos, {out: value}, chunk_rows, inclusive, plain)


def dense_position(df: DataFrame, keys: list[str], order: str, out: str,
                   chunk_rows: int = DEFAULT_CHUNK) -> DataFrame:
    """1-based rank of ``order`` within ``keys`` (values unique per key), skew-safe like running_sum."""
    return running_sum(df, keys, order, F.lit(1), out, chunk_rows=chunk_rows, inclusive=True)


def asof_last(df: DataFrame, keys: list[str], pos: str, kind: str, val: str, out: str,
              chunk_rows: int = DEFAULT_CHUNK, plain: DataFrame | None = None) -> DataFrame:
    """Skew-safe as-of: for every row, the last non-null ``val`` among rows of the same ``keys`` that
    come before it or are the row itself in (``pos``, ``kind``) order. Same two-level scheme as
    ``running_sums``: a window inside (keys, chunk of positions), then, for rows of split keys with nothing in their
    own chunk, the last value of the earlier chunks (a window over one summary row per chunk). ``plain``: rows with
    ``keys``, at least as many for each key, to count in place of ``df``."""
    chunk = "__achunk"
    at, _, split = _chunks(df, keys, pos, chunk_rows, plain)
    d = df.withColumn(chunk, at)
    w_in = Window.partitionBy(*keys, chunk).orderBy(pos, kind).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(val, ignorenulls=True).over(w_in)
    if split is None:
        return d.withColumn(out, last).drop(chunk)
    d = d.withColumn("__local", last)
    # one row per (keys, chunk) present: the last value of the nearest earlier chunk holding values. Rows without a
    # value, most of all, only say which chunks there are
    chunked = df.filter(split).withColumn(chunk, at)
    valued = chunked.filter(F.col(val).isNotNull()).groupBy(*keys, chunk).agg(F.max_by(val, F.struct(pos, kind)).alias("__clast"))
    chunks = chunked.select(*keys, chunk).distinct().unionByName(valued, allowMissingColumns=True) \
        .groupBy(*keys, chunk).agg(F.first("__clast", ignorenulls=True).alias("__clast"))  # one has it
    w_c = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("__carry", F.last("__clast", ignorenulls=True).over(w_c)).drop("__clast")
    d = d.join(chunks, [*keys, chunk], "left")
    return d.withColumn(out, F.coalesce(F.col("__local"), F.col("__carry"))).drop(chunk, "__local", "__carry")


def next_line(starts: DataFrame, events: DataFrame, keys: list[str], out: str) -> DataFrame:
    """For every row of ``starts`` (keys, line): the first line after it at which ``events`` (keys, line)
    has a row with the same keys, or null. Lines are looked at backwards, so this is an as-of."""
    first = keys + ["line"]
    u = starts.select(*first, F.lit(0).alias("__kind"), F.lit(None).cast("int").alias("__at")) \
        .unionByName(events.select(*first, F.lit(1).alias("__kind"), F.col("line").cast("int").alias("__at")))
    found = asof_last(u.withColumn("__pos", -F.col("line")), keys, "__pos", "__kind", "__at", out)
    return found.filter("__kind = 0").select(*first, out)


def running_floor(df: DataFrame, keys: list[str], pos: str, value: str, chunk_rows: int = DEFAULT_CHUNK) -> DataFrame:
    """Add ``total``, the sum of ``value`` up to a row, and ``floor`` / ``floor_before``, the least such sum up to the row
    and up to the row before it (0 if none is lower). (sum, least prefix sum) of stretches compose, so each chunk is
    reduced to that pair, the pairs are scanned, and a window inside the chunk does the rest."""
    chunk = F.floor(F.col(pos) / F.lit(chunk_rows))
    inside = Window.partitionBy(*keys, "__chunk").orderBy(pos)
    upto, before = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    d = df.withColumn("__chunk", chunk).withColumn("__sum", F.sum(value).over(upto))
    d = d.withColumn("__low", F.min("__sum").over(upto)).withColumn("__low_before", F.min("__sum").over(before))
    pairs = d.groupBy(*keys, "__chunk").agg(F.max_by("__sum", pos).alias("__all"), F.min("__sum").alias("__least"))
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    pairs = pairs.withColumn("__base", F.coalesce(F.sum("__all").over(earlier), F.lit(0)))
    pairs = pairs.withColumn("__floor", F.least(F.lit(0), F.coalesce(F.min(F.col("__base") + F.col("__least")).over(earlier), F.lit(0))))
    d = d.join(pairs.drop("__all", "__least"), [*keys, "__chunk"])
    low = F.least(F.col("__floor"), F.col("__base") + F.col("__low")), F.least(F.col("__floor"), F.coalesce(F.col("__base") + F.col("__low_before"), F.lit(0)))
    return d.select(*df.columns, (F.col("__base") + F.col("__sum")).alias("total"), low[0].alias("floor"), low[1].alias("floor_before"))


def next_at_most(points: DataFrame, values: DataFrame, fan: int = 64) -> DataFrame:
    """points(path, line, v): the first later line of values(path, line, v) whose v is not greater, as ``found`` (null if
    there is none). Lines are taken together by ``fan``, these again by ``fan``, and so on; every bundle knows the least
    value of each of its parts. A point looks through its own bundle, then the bundle above and so on, until a part holds
    a value small enough, and goes down into that part again: a few rows a point, whatever the values are."""
    n = values.agg(F.max("line").alias("n")).first()["n"] or 0
    items = values.select("path", F.col("line").cast("long").alias("i"), "v")
    bundles = []
    while True:
        level = items.withColumn("c", F.expr(f"i div {fan}")).groupBy("path", "c").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("parts"))
        bundles.append(level)
        n //= fan
        if not n:
            break
        items = level.select("path", F.col("c").alias("i"), F.array_min(F.transform("parts", lambda x: x["v"])).alias("v"))

    def first(parts: Column, after: Column) -> Column:
        return F.try_element_at(F.filter(parts, lambda x: (x["i"] > after) & (x["v"] <= F.col("v"))), F.lit(1))["i"]

    searching = points.select("path", "line", "v", F.col("line").cast("long").alias("i"))
    hits: list[DataFrame] = []
    for level in bundles:
        met = searching.withColumn("c", F.expr(f"i div {fan}")).join(level, ["path", "c"], "left").withColumn("hit", first(F.col("parts"), F.col("i")))
        met = stored(met.select("path", "line", "v", "c", "hit"), "next-at-most")
        hits.append(met.filter("hit is not null").select("path", "line", "v", F.col("hit").alias("i")))
        searching = met.filter("hit is null").select("path", "line", "v", F.col("c").alias("i"))
    down = None
    for level, found in zip(reversed(bundles), reversed(hits)):
        if down is not None:
            down = down.withColumnRenamed("i", "c").join(level, ["path", "c"]).select("path", "line", "v", first(F.col("parts"), F.lit(-1)).alias("i"))
        down = found if down is None else down.unionByName(found)
    return points.select("path", "line").join(down.select("path", "line", F.col("i").cast("int").alias("found")), ["path", "line"], "left")


def path_order(paths: DataFrame) -> DataFrame:
    """(path, place): a number for each path, growing with the path. Paths are sorted by ranges; the number is the place in
    the range after the range's own, so nothing meets in one task."""
    ranged = paths.select("path").distinct().repartitionByRange("path").sortWithinPartitions("path")
    return stored(ranged.withColumn("place", F.monotonically_increasing_id()), "path-order")
