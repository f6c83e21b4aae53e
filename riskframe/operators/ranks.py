"""Ranks of a globally sorted column without sorting it in one place.

Running totals: rows are first collapsed to one per distinct value.  Quantile splits cut the
value range into buckets of similar size; totals run inside each bucket and the totals of the
earlier buckets are added.  Buckets follow from the value itself, so every pass agrees on them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted
from riskframe.sources.scratch import materialize


def bucket_count(df: DataFrame) -> int:
    """One bucket per shuffle partition."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def numbered(df: DataFrame, order: Sequence[Column | str], out: str, label: str) -> DataFrame:
    """Add ``out``: 0, 1, ... in the given order over all rows; written once.

    Ranges of the order go to the tasks, each numbers its own rows, and the sizes of the earlier
    ranges, one number a task, are added."""
    ranges = df.repartitionByRange(bucket_count(df), *order).sortWithinPartitions(*order)
    rows = materialize(ranges.withColumn("_at", F.monotonically_increasing_id()), label)
    task = F.shiftright("_at", 33)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    sizes = rows.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
    starts = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return rows.withColumn("_task", task).join(F.broadcast(starts), "_task").withColumn(out, place).drop("_task", "_at", "_start")


def running_totals(
    df: DataFrame, value: str, totals: Sequence[str], descending: bool = False, following: Sequence[str] = ()
) -> DataFrame:
    """Add ``cum_<t>`` for every total, its sum over all rows up to and including this one,
    and ``total_<t>``, its sum over all rows.

    ``df`` has one row per value.  ``following`` adds ``next_<c>``: the column's value on the
    next row.
    """
    buckets = bucket_count(df)
    probs = [i / buckets for i in range(1, buckets)]
    sketch = df.agg(F.array_distinct(F.percentile_approx(value, probs, 10 * buckets)).alias("splits")).first()
    splits = [-math.inf, *sorted({float(v) for v in sketch["splits"] or [] if math.isfinite(v)}), math.inf]
    bucketed = Bucketizer(splits=splits, inputCol="_value", outputCol="_place", handleInvalid="keep") if len(splits) > 2 else None
    tagged = df.withColumn("_value", F.col(value).cast("double"))
    tagged = bucketed.transform(tagged) if bucketed else tagged.withColumn("_place", F.lit(0.0))
    position = F.col("_place").cast("int")
    tagged = tagged.withColumn("_bucket", -position if descending else position).drop("_value", "_place")

    direction = F.desc if descending else F.asc
    first_key = F.max_by if descending else F.min_by
    per_bucket = tagged.groupBy("_bucket").agg(
        *[F.sum(t).alias(f"_sum_{t}") for t in totals],
        *[first_key(c, value).alias(f"_first_{c}") for c in following],
    )
    # one row per bucket in these windows and in the broadcast
    across = Window.orderBy("_bucket")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "_bucket",
        *[F.coalesce(F.sum(f"_sum_{t}").over(before), F.lit(0)).alias(f"_off_{t}") for t in totals],
        *[F.sum(f"_sum_{t}").over(Window.partitionBy()).alias(f"total_{t}") for t in totals],
        *[F.lead(f"_first_{c}").over(across).alias(f"_lead_{c}") for c in following],
    )
    inside = Window.partitionBy("_bucket").orderBy(direction(value))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.lead(F.lit(1)).over(inside).isNull()
    return tagged.join(F.broadcast(offsets), "_bucket").select(
        *df.columns,
        *[(F.col(f"_off_{t}") + F.sum(t).over(upto)).alias(f"cum_{t}") for t in totals],
        *[F.col(f"total_{t}") for t in totals],
        *[F.when(last, F.col(f"_lead_{c}")).otherwise(F.lead(c).over(inside)).alias(f"next_{c}") for c in following],
    )


# ---- exact quantiles -------------------------------------------------------------------

SKETCH = 10_000  # percentile_approx accuracy: rank error at most n / SKETCH
LISTED = 50_000  # distinct values of an interval that are listed one by one


@dataclass
class _Rank:
    """A wanted rank (from 0) of a column and the interval known to hold it."""

    column: str
    rank: int
    lo: float
    hi: float
    below: int  # rows under the interval
    inside: int
    listed: bool = False

    @property
    def interval(self) -> tuple[str, float, float]:
        return (self.column, self.lo, self.hi)


def _within(column: str, lo: float, hi: float) -> Column:
    x = quoted(column)
    return F.when((x >= F.lit(lo)) & (x <= F.lit(hi)), x)


def _bracket(df: DataFrame, ranks: list[_Rank]) -> None:
    """Narrow the intervals: a sketch proposes brackets around each rank, a count of the rows
    under, inside and on the ends of each bracket decides.  The ends are settled or cut off, so
    every round makes progress even if they hold nearly all rows.  Two aggregates, no shuffle
    of rows."""
    asked: dict[tuple, list[float]] = {}
    for r in ranks:
        q = (r.rank - r.below + 0.5) / r.inside
        asked.setdefault(r.interval, []).extend([max(0.0, q - 2 / SKETCH), min(1.0, q + 2 / SKETCH)])
    proposed = df.agg(
        *[F.percentile_approx(_within(*i), probs, SKETCH).alias(f"q{k}") for k, (i, probs) in enumerate(asked.items())]
    ).first()
    ends = {i: iter(proposed[f"q{k}"]) for k, i in enumerate(asked)}
    brackets = [(next(ends[r.interval]), next(ends[r.interval])) for r in ranks]
    cells = list(dict.fromkeys((r.column, lo, hi) for r, (lo, hi) in zip(ranks, brackets)))
    counts = df.agg(
        *[F.count_if(quoted(c) < F.lit(lo)).alias(f"b{k}") for k, (c, lo, _) in enumerate(cells)],
        *[F.count(_within(*cell)).alias(f"i{k}") for k, cell in enumerate(cells)],
        *[F.count_if(quoted(c) == F.lit(lo)).alias(f"l{k}") for k, (c, lo, _) in enumerate(cells)],
        *[F.count_if(quoted(c) == F.lit(hi)).alias(f"h{k}") for k, (c, _, hi) in enumerate(cells)],
        *[F.approx_count_distinct(_within(*cell)).alias(f"d{k}") for k, cell in enumerate(cells)],
    ).first()
    for r, (lo, hi) in zip(ranks, brackets):
        k = cells.index((r.column, lo, hi))
        below, inside = counts[f"b{k}"], counts[f"i{k}"]
        if r.rank < below:  # the sketch missed; the rank is still in the part before the bracket
            r.hi, r.inside = math.nextafter(lo, -math.inf), below - r.below
        elif r.rank >= below + inside:
            r.inside -= below + inside - r.below
            r.lo, r.below = math.nextafter(hi, math.inf), below + inside
        elif counts[f"d{k}"] <= LISTED:
            r.lo, r.hi, r.below, r.inside, r.listed = lo, hi, below, inside, True
        elif r.rank < below + counts[f"l{k}"]:
            r.lo, r.hi, r.below, r.inside, r.listed = lo, lo, below, counts[f"l{k}"], True
        elif r.rank >= below + inside - counts[f"h{k}"]:
            on_end = counts[f"h{k}"]
            r.lo, r.hi, r.below, r.inside, r.listed = hi, hi, below + inside - on_end, on_end, True
        else:
            r.lo, r.hi = math.nextafter(lo, math.inf), math.nextafter(hi, -math.inf)
            r.below, r.inside = below + counts[f"l{k}"], inside - counts[f"l{k}"] - counts[f"h{k}"]


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(column, prob, value)`` with linear interpolation between the two nearest ranks.

    Intervals around the wanted ranks shrink by a factor of thousands per round until few
    distinct values are left in them, which are then counted.  The table is only scanned and
    aggregated; nothing is sorted or shuffled, and a value that fills a third of the rows is
    one counted value.  Nulls and NaNs are left out; a column without values gives no row.
    """
    spark = df.sparkSession
    none = F.lit(None).cast("double")
    wide = df.select(*[F.nanvl(quoted(c).cast("double"), none).alias(c) for c in cols])
    stats = wide.agg(
        *[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.min(quoted(c)).alias(f"lo{i}") for i, c in enumerate(cols)],
        *[F.max(quoted(c)).alias(f"hi{i}") for i, c in enumerate(cols)],
    ).first()
    wanted, ranks = [], {}
    for i, c in enumerate(cols):
        n = stats[f"n{i}"]
        for p in probs if n else []:
            h = (n - 1) * p
            pair = (math.floor(h), math.ceil(h))
            wanted.append((c, float(p), h - pair[0], pair))
            for rank in pair:
                ranks[(c, rank)] = _Rank(c, rank, stats[f"lo{i}"], stats[f"hi{i}"], 0, n)
    while open_ranks := [r for r in ranks.values() if not r.listed]:
        _bracket(wide, open_ranks)

    intervals = list(dict.fromkeys(r.interval for r in ranks.values()))
    hits = F.array_compact(
        F.array(*[F.when(_within(*i).isNotNull(), F.struct(F.lit(k).alias("k"), quoted(i[0]).alias("v"))) for k, i in enumerate(intervals)])
    )
    listed: dict[int, list[tuple]] = {}
    if intervals:
        for row in wide.select(F.inline(hits)).groupBy("k", "v").count().collect():
            listed.setdefault(row["k"], []).append((row["v"], row["count"]))
    value = {}
    for key, r in ranks.items():
        at = r.below
        for v, count in sorted(listed[intervals.index(r.interval)]):
            at += count
            if r.rank < at:
                value[key] = v
                break
    rows = [(c, p, value[c, a] + (value[c, b] - value[c, a]) * part) for c, p, part, (a, b) in wanted]
    return spark.createDataFrame(rows, "column string, prob double, value double")
