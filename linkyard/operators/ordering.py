"""Encounter order: samples, caps, a global reference index and batches.

The global index (W1) is an exclusive prefix sum over *lines* (each line
weighs its number of references), not a window over all references:

1. lines are cut into key-range buckets of at most ``width`` lines, so no
   bucket can grow with a hot key (line keys are unique);
2. one hash exchange on the bucket feeds both the per-bucket totals and the
   per-line running sum (Spark reuses the exchange, so the regex runs once);
3. bucket bases come from a running sum over the bucket totals, a table
   ``width`` times smaller than the lines; while that table is still large
   its running sum is found the same way, one level up (``FANOUT`` buckets
   per upper bucket), and over many files the top table is cut into ranges of
   paths, so the one-task running sum only sees a table that is small whatever
   the data size;
4. a line's base + the position of a reference in it = its index.

Lines scanned from files (``file_path, split, record``) need none of that: the scan task itself numbers the
references it meets, and a small table with one row per input split tells how many references the earlier splits
hold (``indexed_file_refs``).  No line and no URL is shuffled.

Nothing is materialised and nothing depends on partition ids, so a lost
executor just recomputes its tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.extract import might_hold_url
from ..functions.patterns import DEFAULT_BATCH_SIZE
from ..session import SPLIT_BROADCAST_ROWS, scan_partitions
from .refs import extract_refs, filter_http, line_key, ref_key, refs_array

# Upper bound of lines per bucket: a bucket is one window partition.
MAX_BUCKET_WIDTH = 1 << 20
# Per-file line numbers start at 0 and are dense: a fixed width needs no
# min/max job (which would read the text again).  ~13 MB of index text a bucket.
FILE_BUCKET_WIDTH = 1 << 16
# Buckets of one level per bucket of the next level up.
FANOUT = 1 << 16
# Files per range of paths at the top level, and the most ranges: a one-task sum over ranges.
FILES_PER_RANGE, MOST_RANGES = 1000, 4096
# Widths stay inside a long (very sparse keys can ask for more).
MAX_WIDTH = 1 << 62
# A bucket table up to this size gets its running sum in one task.
TOP_LEVEL_ROWS = 1 << 16


def _require_number(df: DataFrame) -> None:
    """Encounter order needs a line key: without ``line_no`` or ``record`` the order would be arbitrary."""
    if "line_no" not in df.columns and "record" not in df.columns:
        raise ValueError("encounter order needs a line_no or record column; read the lines with read_lines or read_lines_ordered")


def _bucket_width(df: DataFrame, num: str) -> tuple[int, int, int]:
    """(low key, width, bucket count) so the key range splits into ~4 buckets
    per shuffle partition, with at most ``MAX_BUCKET_WIDTH`` keys a bucket."""
    row = df.agg(F.min(num).alias("lo"), F.max(num).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return 0, 1, 0
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = int(hi) - int(lo) + 1
    width = max(1, min(MAX_BUCKET_WIDTH, -(-span // (4 * parts))))
    return int(lo), width, -(-span // width)


def _levels_for(n_buckets: int) -> int:
    """Extra levels needed until the top bucket table is one-task small."""
    levels = 0
    while n_buckets > TOP_LEVEL_ROWS:
        n_buckets = -(-n_buckets // FANOUT)
        levels += 1
    return levels


def _path_bounds(df: DataFrame, files_per_range: int = FILES_PER_RANGE, most: int = MOST_RANGES) -> list[str]:
    """Paths that cut the input's files, by name, into ranges of about ``files_per_range`` (``most`` at
    most), from the listing the driver holds anyway."""
    n = len(df._jdf.inputFiles())  # a length, no names
    ranges = min(most, -(-n // files_per_range))
    if ranges < 2:
        return []
    files = sorted(df.inputFiles())
    return [files[n * i // ranges] for i in range(1, ranges)]


def _range_bases(totals: DataFrame, grp: list[str], last: str, total: str, base: str, bounds: list[str]) -> DataFrame:
    """``totals`` with ``base``, the sum of all totals before each in ``(*grp, last)`` order: a running sum
    within each range of the first group column, and one over the ranges."""
    cuts = F.array(*[F.lit(b) for b in bounds])
    rng = F.size(F.filter(cuts, lambda b: b <= F.col(grp[0])))
    ranged = totals.withColumn("_lk_range", rng)
    over = Window.orderBy("_lk_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    heads = ranged.groupBy("_lk_range").agg(F.sum(total).alias("_lk_range_total")).select(
        "_lk_range", F.coalesce(F.sum("_lk_range_total").over(over), F.lit(0)).alias("_lk_range_base"))
    within = Window.partitionBy("_lk_range").orderBy(*grp, last).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.withColumn("_lk_in_range", F.coalesce(F.sum(total).over(within), F.lit(0))).join(heads, "_lk_range", "left").withColumn(
        base, F.col("_lk_range_base") + F.col("_lk_in_range")).drop("_lk_range", "_lk_range_base", "_lk_in_range")


def _prefix_level(df: DataFrame, grp: list[str], num: str, w: Column, out: str,
                  low: int, width: int, level: int, levels: int, fanout: int, bounds: list[str]) -> DataFrame:
    tag = f"_lk{level}"
    bkt, total, last, base = f"{tag}_bucket", f"{tag}_total", f"{tag}_last", f"{tag}_base"
    keyed = df.withColumn(bkt, F.expr(f"(`{num}` - {low}) div {width}")).repartition(*grp, bkt)
    # Buckets are contiguous key ranges, so ordering them by their last key
    # is ordering them by bucket; it also makes this branch read the same
    # columns as the running sum below (one exchange, reused).
    totals = keyed.groupBy(*grp, bkt).agg(F.sum(w).alias(total), F.max(num).alias(last))
    if level < levels:
        # The bucket table is still large: number it the same way, one level
        # up.  The bucket id is not carried up but recomputed from the
        # bucket's last key, so both consumers of the upper exchange read the
        # same columns (one exchange, reused) and the totals are built once.
        upper = _prefix_level(totals.select(*grp, total, last), grp, last, F.col(total), base,
                              low, min(width * fanout, MAX_WIDTH), level + 1, levels, fanout, bounds)
        bases = upper.select(*grp, F.expr(f"(`{last}` - {low}) div {width}").alias(bkt), base)
    elif grp and bounds:
        bases = _range_bases(totals, grp, last, total, base, bounds).select(*grp, bkt, base)
    else:
        before_bucket = Window.orderBy(*grp, last).rowsBetween(Window.unboundedPreceding, -1)
        bases = totals.select(*grp, bkt, F.coalesce(F.sum(total).over(before_bucket), F.lit(0)).alias(base))
    before_row = Window.partitionBy(*grp, bkt).orderBy(num).rowsBetween(Window.unboundedPreceding, -1)
    return (
        # Every bucket has a base row; a left join infers no extra filter on
        # ``keyed``, which keeps its exchange identical to the totals' one.
        keyed.join(bases, on=[*grp, bkt], how="left")
        .withColumn(out, (F.col(base) + F.coalesce(F.sum(w).over(before_row), F.lit(0))).cast("long"))
        .drop(bkt, base)
    )


def exclusive_prefix_sum(
    df: DataFrame,
    order_cols: list[str],
    weight: str | Column,
    out: str,
    width: int | None = None,
    low: int | None = None,
    levels: int | None = None,
    fanout: int = FANOUT,
    bounds: list[str] | None = None,
) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over all rows strictly before each row.

    ``order_cols``: leading group columns (ordered as strings/values), then
    one integer column unique within the group (e.g. ``file_path, line_no``)
    whose values span less than 2**63.  ``weight`` is a column name or an
    expression over ``df``'s columns.

    Rows go into key-range buckets of ``width`` keys; bucket bases come from
    the same procedure one level up (``FANOUT`` buckets a bucket) until the
    top table is small.  Over many files the top table has a row per file: it is
    cut into ranges of paths at ``bounds`` (taken from the input's listing), and the one-task
    sum sees one row per range.

    When ``df`` holds only the order columns and what ``weight`` reads, both
    consumers of the bucket exchange (totals and running sum) need the same
    columns, so Spark plans one exchange and reuses it.
    """
    *grp, num = order_cols
    w = F.col(weight) if isinstance(weight, str) else weight
    if (width is None or low is None) and order_cols[:1] == ["file_path"] and num in ("line_no", "record"):
        # Numbers that run on along a file or split: size is unknown but no job is needed.
        low, width = 0, FILE_BUCKET_WIDTH
        levels = 1 if levels is None else levels
    if width is None or low is None:
        low, width, n_buckets = _bucket_width(df, num)
        levels = _levels_for(n_buckets) if levels is None else levels
    if bounds is None:
        bounds = _path_bounds(df) if grp[:1] == ["file_path"] else []
    return _prefix_level(df, grp, num, w, out, low, width, 0, levels or 0, fanout, bounds)


def with_ordinal(df: DataFrame, order_cols: list[str], out: str = "ordinal") -> DataFrame:
    """0-based rank of each row in ``order_cols`` order (keys must be unique).

    The weight of a row is 1, written so that it reads every other column: the totals then need the same columns as the running
    sum, both read one exchange, and the input is scanned once."""
    others = [F.col(c).isNull().cast("long") for c in df.columns if c not in order_cols]
    return exclusive_prefix_sum(df, order_cols, F.greatest(F.lit(1).cast("long"), *others) if others else F.lit(1), out)


def indexed_file_refs(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(file_path, split, record, pos, file_url, ref_index)`` of lines scanned from files, by path and place.

    References are numbered in the scan task, after the explode (``monotonically_increasing_id`` rises along a split); a
    table with one row per split, its first number and its count, gives every split the number of references before it by
    a running sum in (path, split) order.  The text is scanned twice and never shuffled; both scans are planned from one listing,
    so they number alike, also in a task that runs again.
    """
    found = filter_http(extract_refs(lines, "both", value)).withColumn("_lk_rid", F.monotonically_increasing_id())
    totals = found.groupBy("file_path", "split").agg(F.min("_lk_rid").alias("_lk_rid0"), F.count(F.lit(1)).alias("_lk_n"))
    bounds = _path_bounds(lines)
    if bounds:
        bases = _range_bases(totals, ["file_path"], "split", "_lk_n", "_lk_base", bounds)
    else:
        before = Window.orderBy("file_path", "split").rowsBetween(Window.unboundedPreceding, -1)
        bases = totals.withColumn("_lk_base", F.coalesce(F.sum("_lk_n").over(before), F.lit(0)))
    bases = bases.select("file_path", "split", "_lk_rid0", "_lk_base")
    # One row per split at most: files and partitions are known from the listing.
    if len(lines._jdf.inputFiles()) + (scan_partitions(lines) or 0) <= SPLIT_BROADCAST_ROWS:
        bases = F.broadcast(bases)
    return found.join(bases, ["file_path", "split"]).select(
        "file_path", "split", "record", "pos", "file_url", (F.col("_lk_base") + F.col("_lk_rid") - F.col("_lk_rid0")).alias("ref_index"))


def indexed_refs(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(<line key>, pos, file_url, ref_index)``: 0-based global encounter index.

    A line weighs ``size(refs)``; every match passes the ``http`` guard (both
    patterns start with it), so the guard after the explode drops nothing
    and leaves no gap in the index.
    """
    _require_number(lines)
    if "record" in lines.columns:
        return indexed_file_refs(lines, value)
    keys = line_key(lines)
    per_line = lines.where(F.col(value).contains("http")).select(*keys, refs_array(value).alias("_lk_refs"))
    based = exclusive_prefix_sum(per_line, keys, F.size("_lk_refs"), "_lk_line_base")
    exploded = based.select(*keys, F.posexplode("_lk_refs").alias("pos", "file_url"), "_lk_line_base")
    return filter_http(exploded).select(
        *keys, "pos", "file_url", (F.col("_lk_line_base") + F.col("pos")).alias("ref_index"))


def assign_batches(lines: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE, value: str = "value") -> DataFrame:
    """W1 + A6: each reference with its write batch (1-based, ``batch_size`` each)."""
    return indexed_refs(lines, value).withColumn(
        "batch_no", (F.expr(f"ref_index div {int(batch_size)}") + 1).cast("long")
    )


def batch_counts(refs: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """``(batch_no, n_refs)`` for ``ceil(n / batch_size)`` batches, from the total alone.

    Every batch but the last is full, so the sizes follow from ``count(*)``, which runs
    when this is called; the batches themselves are a distributed ``range``.
    """
    size, spark = int(batch_size), refs.sparkSession
    n = refs.count()
    left = F.lit(n) - (F.col("batch_no") - 1) * F.lit(size).cast("long")
    return spark.range(1, -(-n // size) + 1).select(F.col("id").alias("batch_no")).select(
        "batch_no", F.least(F.lit(size).cast("long"), left.cast("long")).alias("n_refs"))


def first_refs(refs: DataFrame, n: int) -> DataFrame:
    """L1/L2: the first ``n`` references in encounter order, with their rank.

    Top-k is the feature here: ``n`` rows per partition, merged in one task.  For a cap
    that may be large use ``cap_records``, which filters on the global index.
    """
    order = ref_key(refs)
    _require_number(refs)
    top = refs.orderBy(*order).limit(n)
    # ``n`` rows only, so ranking them in one partition is fine.
    return top.withColumn("sample_rank", F.row_number().over(Window.orderBy(*order)))


# Lines whose keys the first step of a sample looks at.
FIRST_LINES = 100


def first_refs_of_lines(lines: DataFrame, n: int, value: str = "value") -> DataFrame:
    """The first ``n`` references of numbered ``lines``, ranked, without extracting from all lines if the first few do.

    The keys of the first ``FIRST_LINES`` lines that can hold a URL bound the first try.  If the lines up to there hold fewer
    than ``n`` references, the second and last step is a top-k over the references of all lines: each task keeps
    ``n`` of them.  No line value leaves a task, and the driver gets ``FIRST_LINES`` keys or ``n`` references at most.
    """
    _require_number(lines)
    keys = line_key(lines)
    heads = lines.where(might_hold_url(value)).select(*keys).orderBy(*keys).limit(FIRST_LINES).collect()
    if len(heads) == FIRST_LINES:
        last = F.struct(*[F.lit(heads[-1][k]).alias(k) for k in keys])
        few = first_refs(filter_http(extract_refs(lines.where(F.struct(*keys) <= last), "both", value)), n)
        found = few.collect()  # n references at most
        if len(found) == n:
            return lines.sparkSession.createDataFrame(found, few.schema)
    return first_refs(filter_http(extract_refs(lines, "both", value)), n)


def cap_records(lines: DataFrame, max_records: int, value: str = "value") -> DataFrame:
    """L3: the first ``max_records`` references in encounter order; 0 keeps all.

    ``(<line key>, pos, file_url)``, exact and distributed at any cap.  Of lines keyed by a number, only those up to the
    key range in which the count of references reaches the cap are numbered.  (Over files, ``cap_file_refs`` also leaves the files
    closed that the cap doesn't need.)
    """
    if max_records <= 0:
        return extract_refs(lines, "both", value)
    _require_number(lines)
    return indexed_refs(_keys_for(lines, max_records, value), value).where(F.col("ref_index") < max_records).drop("ref_index")


def _keys_for(lines: DataFrame, n: int, value: str) -> DataFrame:
    """The lines up to the end of the key range in which the running count of references reaches ``n``.

    The ranges are those of the prefix sum, counted by a partial aggregate: one row a range, no text moves."""
    *grp, num = line_key(lines)
    if grp:
        return lines
    low, width, n_ranges = _bucket_width(lines, num)
    counts = lines.where(might_hold_url(value)).groupBy(F.expr(f"(`{num}` - {low}) div {width}").alias("_lk_range")).agg(
        F.sum(F.size(refs_array(value))).alias("_lk_n"))
    if n_ranges > TOP_LEVEL_ROWS:  # too many ranges for one running sum: coarser ones
        width *= -(-n_ranges // TOP_LEVEL_ROWS)
        counts = lines.where(might_hold_url(value)).groupBy(F.expr(f"(`{num}` - {low}) div {width}").alias("_lk_range")).agg(
            F.sum(F.size(refs_array(value))).alias("_lk_n"))
    so_far = Window.orderBy("_lk_range").rowsBetween(Window.unboundedPreceding, 0)
    reached = counts.withColumn("_lk_so_far", F.sum("_lk_n").over(so_far)).where(F.col("_lk_so_far") >= n).agg(F.min("_lk_range")).first()[0]
    return lines if reached is None else lines.where(F.col(num) < low + (reached + 1) * width)
