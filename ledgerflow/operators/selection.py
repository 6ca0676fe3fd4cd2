"""Distributed selection primitives (O-3, CR-2 ranks, SY-5 weighted draw).

* ``exact_k`` picks exactly ``k`` rows without replacement: the rows with the
  ``k`` smallest ``(h, tie-breakers)`` tuples, ``h`` being a 52-bit row hash.
  A histogram of hash-prefix buckets (bounded: 2^bits rows) finds the bucket
  where the k-th row lies; while that bucket is large, a histogram of the next
  ``REFINE_BITS`` hash bits inside it finds the sub-bucket, and so on.  A
  row_number over the few rows that are left gives the k-th tuple ``T``
  (several selections share each pass and one threshold job).  Selection is then the per-row predicate ``tuple <= T`` -- no
  global sort, no join, nothing unbounded on the driver.
* ``ranked`` numbers selected rows 1..k in tuple order: ``row_number`` per
  bucket plus the bucket's offset from the histogram (no unpartitioned window).
* ``interval_draw`` maps integers ``r`` in [0, total) to the interval
  ``[lo, hi)`` containing them by an equi-join on fixed-width bins; a hot
  interval spans many bins, so draws stay evenly spread over join keys.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.uniform import HASH_BITS

# Rows that may be shipped in a broadcast hash table by these helpers (each task holds the whole of it).
BROADCAST_MAX_ROWS = 100_000
# Rows that one task sorts or joins.
TASK_ROWS = 500_000
# Bins generated from one row at most (splits a hot interval across tasks).
CHUNK_BINS = 1024
# Rows of a cut bucket that one task may rank; a larger one is cut by further hash bits.
CUT_ROWS = 250_000
REFINE_BITS = 12


def bucket_bits(n_rows: int, target_per_bucket: int = 250_000) -> int:
    """Histogram resolution: ~target rows per bucket, between 2^8 and 2^18 buckets
    (the histogram reaches the driver; at 10^12 rows a bucket holds ~4M rows)."""
    want = max(1, math.ceil(n_rows / target_per_bucket))
    return min(18, max(8, math.ceil(math.log2(want))))


def _bucket(h: Column, bits: int) -> Column:
    return F.shiftright(h, HASH_BITS - bits)


def _tuple(h: str, tiebreak: list[str]) -> Column:
    return F.struct(F.col(h).alias("h"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tiebreak)])


@dataclass
class Selection:
    """Result of ``exact_k``: a per-row predicate plus what ranks need."""
    k: int
    h_col: str
    tiebreak: list[str]
    bits: int
    cut_bucket: int | None            # None: nothing selected
    threshold: tuple | None           # k-th smallest (h, tiebreak...) tuple
    offsets: list[tuple[int, int]]    # (bucket, rows before it) for buckets <= cut
    dtypes: list = None               # Spark types of (h, tiebreak...)

    def predicate(self) -> Column:
        if self.cut_bucket is None or self.threshold is None:
            return F.lit(False)
        t = F.struct(*[F.lit(v).cast(dt).alias("h" if i == 0 else f"t{i - 1}")
                       for i, (v, dt) in enumerate(zip(self.threshold, self.dtypes))])
        b = _bucket(F.col(self.h_col), self.bits)
        # The bucket test is implied by the tuple test; it lets whole buckets
        # be decided without comparing structs.
        return (b < F.lit(self.cut_bucket)) | (
            (b == F.lit(self.cut_bucket)) & (_tuple(self.h_col, self.tiebreak) <= t))


def exact_k(df: DataFrame, k: int, h_col: str, tiebreak: list[str],
            bits: int | None = None, n_rows: int | None = None, cut_rows: int = CUT_ROWS) -> Selection:
    """Plan an exact-k selection over ``df`` (small actions: histogram, refinements, cut)."""
    return exact_k_many(df, [(k, h_col, tiebreak)], bits, n_rows, cut_rows)[0]


def exact_k_many(df: DataFrame, specs: list[tuple[int, str, list[str]]],
                 bits: int | None = None, n_rows: int | None = None, cut_rows: int = CUT_ROWS) -> list[Selection]:
    """Several independent exact-k selections over the same rows.

    All histograms come from one pass (each row contributes one bucket per
    selection, tagged by selection index); large cut buckets are refined, all in
    one pass for each further ``REFINE_BITS``; then one bounded top-k per
    selection inside what is left of its cut bucket.
    """
    if bits is None:
        if n_rows is None:
            n_rows = df.count()
        bits = bucket_bits(n_rows)
    active = [i for i, (k, _, _) in enumerate(specs) if k > 0]
    hists: dict[int, list[tuple[int, int]]] = {i: [] for i in active}
    if active:
        tagged = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("s"), _bucket(F.col(specs[i][1]), bits).alias("b"))
            for i in active])).alias("t")).select("t.s", "t.b")
        for r in tagged.groupBy("s", "b").agg(F.count(F.lit(1)).alias("n")).collect():
            hists[r["s"]].append((r["b"], r["n"]))
    plans = {}
    for i, (k, h_col, tiebreak) in enumerate(specs):
        if k > 0:
            plans[i] = _locate(k, sorted(hists[i]))
    thresholds = _thresholds(df, specs, _refined(df, specs, plans, bits, cut_rows))
    out = []
    for i, (k, h_col, tiebreak) in enumerate(specs):
        dtypes = [df.schema[h_col].dataType] + [df.schema[c].dataType for c in tiebreak]
        if k <= 0:
            out.append(Selection(0, h_col, tiebreak, bits, None, None, [], dtypes))
            continue
        cut, taken, offsets, *_ = plans[i]
        out.append(Selection(taken, h_col, tiebreak, bits, cut, thresholds.get(i), offsets, dtypes))
    return out


def _locate(k: int, hist: list[tuple[int, int]]):
    """(cut bucket, rows selected, bucket offsets, rank of the k-th row inside the cut, rows of the cut)."""
    before, offsets = 0, []
    for bucket, n in hist:
        offsets.append((bucket, before))
        if before + n >= k:
            return bucket, k, offsets, k - before, n
        before += n
    if not hist:
        return None, 0, offsets, 0, 0
    last, n_last = hist[-1]
    return last, before, offsets, n_last, n_last  # k >= all rows: everything is selected


@dataclass
class _Cut:
    """Where the wanted row is: the bucket of the first ``bits`` hash bits, and its rank there."""
    bits: int
    bucket: int
    rank: int
    rows: int


def _refined(df: DataFrame, specs, plans: dict, bits: int, cut_rows: int) -> dict[int, _Cut]:
    """Cut buckets of more than ``cut_rows`` rows are cut by further bits until they are small.

    Each pass reads the rows of the large buckets only and brings at most 2^REFINE_BITS counts for each
    selection to the driver.  Rows of one equal hash can't be told apart by bits: the tie-breakers do that.
    """
    cuts = {i: _Cut(bits, cut, rank, n) for i, (cut, _, _, rank, n) in plans.items() if cut is not None and rank > 0}
    while True:
        large = {i: c for i, c in cuts.items() if c.rows > cut_rows and c.bits < HASH_BITS}
        if not large:
            return cuts
        parts = []
        for i, c in large.items():
            h, deeper = F.col(specs[i][1]), min(HASH_BITS, c.bits + REFINE_BITS)
            parts.append(df.where(_bucket(h, c.bits) == F.lit(c.bucket)).select(F.lit(i).alias("s"), _bucket(h, deeper).alias("b")))
        hists: dict[int, list[tuple[int, int]]] = {i: [] for i in large}
        for r in reduce(DataFrame.unionByName, parts).groupBy("s", "b").agg(F.count(F.lit(1)).alias("n")).collect():
            hists[r["s"]].append((r["b"], r["n"]))
        for i, c in large.items():
            bucket, _, _, rank, n = _locate(c.rank, sorted(hists[i]))
            cuts[i] = _Cut(min(HASH_BITS, c.bits + REFINE_BITS), bucket, rank, n)


def _thresholds(df: DataFrame, specs, cuts: dict[int, _Cut]) -> dict[int, tuple]:
    """The k-th (h, tiebreak...) tuple of every selection, from one job.

    Only the rows of each selection's refined cut bucket take part; a row_number per selection finds the tuple at the needed rank.
    Selections whose tuples have different types get their own job.
    """
    from pyspark.sql import Window

    groups: dict[str, list[int]] = {}
    for i in cuts:
        _, h_col, tiebreak = specs[i]
        sig = str([df.schema[h_col].dataType] + [df.schema[c].dataType for c in tiebreak])
        groups.setdefault(sig, []).append(i)
    found: dict[int, tuple] = {}
    for members in groups.values():
        parts = []
        for i in members:
            cut = cuts[i]
            _, h_col, tiebreak = specs[i]
            parts.append(df.where(_bucket(F.col(h_col), cut.bits) == F.lit(cut.bucket))
                         .select(F.lit(i).alias("_s"), F.lit(cut.rank).alias("_need"),
                                 _tuple(h_col, tiebreak).alias("t")))
        rows = reduce(DataFrame.unionByName, parts)
        w = Window.partitionBy("_s").orderBy("t")
        for r in (rows.withColumn("_rn", F.row_number().over(w))
                  .where(F.col("_rn") == F.col("_need")).select("_s", "t").collect()):
            found[r["_s"]] = tuple(r["t"])
    return found


def ranked(spark: SparkSession, selected: DataFrame, sel: Selection, rank_col: str = "rank"
           ) -> DataFrame:
    """Number the selected rows 1..k in (h, tiebreak) order.

    ``row_number`` is partitioned by bucket (each bucket is bounded by the
    histogram resolution); the bucket offset comes from a broadcast of at most
    2^bits (bucket, offset) rows.
    """
    from pyspark.sql import Window
    offs = spark.createDataFrame(sel.offsets or [(0, 0)], "_b long, _off long")
    w = Window.partitionBy("_b").orderBy(F.col(sel.h_col), *[F.col(c) for c in sel.tiebreak])
    with_b = selected.withColumn("_b", _bucket(F.col(sel.h_col), sel.bits))
    return (with_b.join(F.broadcast(offs), "_b", "inner")
            .withColumn(rank_col, (F.col("_off") + F.row_number().over(w)).cast("bigint"))
            .drop("_b", "_off"))


def maybe_broadcast(df: DataFrame, n_rows: int, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast only when the row count (known from a prior aggregate) is bounded."""
    return F.broadcast(df) if n_rows <= max_rows else df


def dealt_over(df: DataFrame, n_rows: int, *cols: str) -> DataFrame:
    """Shuffled by these columns, over as many tasks as ``n_rows`` need: what a task sorts doesn't grow with the input."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // TASK_ROWS)), *cols)


def interval_draw(draws: DataFrame, r_col: str, intervals: DataFrame, lo_col: str, hi_col: str,
                  total: int, n_intervals: int, group_cols: list[str] | None = None,
                  payload: list[str] | None = None, n_draws: int = 0) -> DataFrame:
    """Attach to each of the ``n_draws`` draws the interval [lo, hi) (within its group) containing ``r``.

    Bin width W = ceil(total / n_intervals), so the exploded interval table has
    at most ~2 * n_intervals rows and each bin holds about two intervals.
    """
    group_cols = group_cols or []
    payload = payload or [c for c in intervals.columns if c not in (lo_col, hi_col, *group_cols)]
    width = max(1, math.ceil(total / max(1, n_intervals)))
    lo, hi = F.col(lo_col), F.col(hi_col)
    first = F.floor(lo / width).cast("bigint")
    last = F.floor((hi - 1) / width).cast("bigint")
    # A hot interval (one account with a third of all rows) spans a third of all
    # bins: cut it into chunks of CHUNK_BINS bins, spread the chunks over tasks
    # by hash, and only then expand each chunk into its bins.
    chunks = (intervals.where(hi > lo)
              .select(*group_cols, lo.alias("_lo"), hi.alias("_hi"), *payload,
                      first.alias("_first"), last.alias("_last"))
              .withColumn("_c", F.explode(F.sequence(
                  F.lit(0).cast("bigint"),
                  F.floor((F.col("_last") - F.col("_first")) / CHUNK_BINS).cast("bigint")))))
    chunks = chunks.repartition("_lo", "_c")
    start = F.col("_first") + F.col("_c") * CHUNK_BINS
    exploded = (chunks.withColumn("_bin", F.explode(F.sequence(
        start, F.least(F.col("_last"), start + (CHUNK_BINS - 1)))))
        .drop("_first", "_last", "_c"))
    n_exploded = n_intervals + total // width + 1
    binned = draws.withColumn("_bin", F.floor(F.col(r_col) / width).cast("bigint"))
    key = [*group_cols, "_bin"]
    if n_exploded > BROADCAST_MAX_ROWS:
        size = max(n_draws, n_exploded)
        binned, exploded = dealt_over(binned, size, *key), dealt_over(exploded, size, *key)
    joined = binned.join(maybe_broadcast(exploded, n_exploded), key, "inner")
    return (joined.where((F.col(r_col) >= F.col("_lo")) & (F.col(r_col) < F.col("_hi")))
            .drop("_bin", "_lo", "_hi"))


def prefix_intervals(spark: SparkSession, counts: DataFrame, count_col: str, order_cols: list[str],
                     bits: int = 12, key_for_bucket: str | None = None) -> DataFrame:
    """Cumulative [lo, hi) of ``count_col`` in (bucket, order_cols) order, distributed.

    Rows are spread over 2^bits hash buckets of ``key_for_bucket``; per-bucket
    totals (bounded) give each bucket's offset, and a window partitioned by
    bucket gives the running sum inside it.  Never an unpartitioned window.
    """
    from pyspark.sql import Window

    from ..functions.uniform import hash_bucket
    key = key_for_bucket or order_cols[0]
    with_b = counts.withColumn("_b", hash_bucket(bits, key))
    totals = with_b.groupBy("_b").agg(F.sum(count_col).alias("_t"))
    offs = totals.withColumn(
        "_off", F.sum("_t").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)))
    offs = offs.select("_b", F.coalesce(F.col("_off"), F.lit(0)).cast("bigint").alias("_off"))
    w = (Window.partitionBy("_b").orderBy(*[F.col(c) for c in order_cols])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (with_b.join(F.broadcast(offs), "_b", "inner")
           .withColumn("cum_hi", (F.col("_off") + F.sum(count_col).over(w)).cast("bigint")))
    return (out.withColumn("cum_lo", (F.col("cum_hi") - F.col(count_col)).cast("bigint"))
            .withColumnRenamed("_b", "bucket").drop("_off"))
