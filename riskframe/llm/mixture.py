"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash position.  Sizes are summed by source and by the leading digits of
that position; running totals of the sums show in which bucket each budget ends.  Only that
bucket is summed again by the next digits.  Documents are then taken by their position alone:
no sort of documents, and a larger budget always holds what a smaller one holds (budgets are
nested: a source used 2.4 times is taken twice in full and once up to 40 % of its size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.shared import WORD, materialize, table

DIGITS = 3  # hex digits a level: 4,096 buckets
LEVELS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """Target of each source from its size.

    ``sizes``: source, source_size.  Sources by code point, null last, weigh ``weights`` in
    turn and share the sum of all sizes; a target stops at ``cap`` sizes and the excess goes to
    the others by weight until none is above.  That ends at one rate per weight for all
    uncapped sources, and the capped ones are those with the smallest cap per weight, so a
    running sum in that order finds the rate.  One row per source passes through one task.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * cap).alias("most"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    rates = ranked.select(
        "*",
        (
            (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(rest)
        ).alias("rate"),
        F.row_number().over(order).alias("place"),
    )
    fits = F.when(F.col("rate") * F.col("weight") <= F.col("most"), F.struct("place", "rate"))
    shared = rates.select("source", "source_size", "weight", "most", F.min(fits).over(every)["rate"].alias("rate"))
    return shared.select(
        "source",
        "source_size",
        F.least(F.col("rate") * F.col("weight"), F.col("most").cast("double")).alias("target"),
    )


def _decide(sums: DataFrame, path: list[str], last: bool, cap: int) -> DataFrame:
    """Running totals of the buckets in ``path`` order, and how many budgets each bucket is
    inside of.  ``open`` marks buckets in which a budget ends."""
    order = Window.partitionBy(*path[:-1]).orderBy(path[-1])
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = sums.withColumn("after", F.col("base") + F.sum("size").over(upto)).withColumn("before", F.col("after") - F.col("size"))
    copies, open_ = F.lit(0), F.lit(False)
    for k in range(1, cap + 1):
        budget, live = F.col(f"budget{k}"), F.col(f"live{k}")
        inside = live & (F.col("after") <= budget)
        ends = live & (F.col("before") < budget) & (budget < F.col("after"))
        if last:  # the bucket that holds the end goes to the nearer side
            inside = inside | (ends & (2 * budget >= F.col("before") + F.col("after")))
        copies = copies + inside.cast("int")
        open_ = open_ | ends
        run = run.withColumn(f"ends{k}", ends)
    run = run.withColumn("copies", copies).withColumn("open", open_ & F.lit(not last))
    for k in range(1, cap + 1):
        run = run.withColumn(f"live{k}", F.col(f"ends{k}"))
    return run.drop(*[f"ends{k}" for k in range(1, cap + 1)])


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    cap: int = 3,
    seed: str = "mix",
    position: str | None = None,
) -> DataFrame:
    """How often each document is taken so that sources reach their targets.

    Returns key, size (words), source_size, target, copies (0 to ``cap``), taken (size times
    copies), in no order, one row per input row.  Null texts and null keys are allowed (size 0;
    one hash position for all null keys); equal rows share a position and are taken alike; a
    null source is a source of its own.  Documents of size 0 take nothing.  An empty table
    gives an empty result.  Each source differs from its target by half of its boundary
    bucket at most, which with 36 bits of position is one document or a set of equal keys.

    ``position``: column that gives the hash position in place of the key, for keys that number
    the rows anew in every run.  The key then places only the rows that all levels but the last
    leave together, so rows that are equal in ``position`` are told apart.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(position or key).cast("string")))
    own = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    path = [f"p{i}" for i in range(1, LEVELS + 1)]
    sized = materialize(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            *[F.substring(digest if i < LEVELS - 1 else own, 1 + i * DIGITS, DIGITS).alias(p) for i, p in enumerate(path)],
        ),
        "mix-sizes",
    ).withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    first = sized.groupBy("src", "p1").agg(F.first("source").alias("source"), F.sum("size").alias("size"))
    first = materialize(first, "mix-histogram")
    targets = source_targets(
        first.groupBy("src").agg(F.first("source").alias("source"), F.sum("size").alias("source_size")).drop("src"), weights, cap
    ).withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    size, target = F.col("source_size"), F.col("target")
    for k in range(1, cap + 1):
        budget = F.greatest(F.lit(0.0), F.least(size.cast("double"), target - (k - 1) * size))
        targets = targets.withColumn(f"budget{k}", budget).withColumn(f"live{k}", F.lit(True))
    carried = [f"{c}{k}" for k in range(1, cap + 1) for c in ("budget", "live")]
    sums = first.join(targets.drop("source"), "src").withColumn("base", F.lit(0).cast("long"))
    decided = materialize(_decide(sums, ["src", "p1"], LEVELS == 1, cap), "mix-level")
    out = sized.join(decided.select("src", "p1", "source_size", "target", F.col("copies").alias("copies1")), ["src", "p1"])
    pool = sized
    for level in range(2, LEVELS + 1):
        upper, here = ["src", *path[: level - 1]], ["src", *path[:level]]
        ends = decided.where("open").select(*upper, F.col("before").alias("base"), *carried)
        pool = pool.join(ends.select(*upper), upper, "left_semi")
        sums = pool.groupBy(*here).agg(F.sum("size").alias("size")).join(ends, upper)
        decided = materialize(_decide(sums, here, level == LEVELS, cap), "mix-level")
        out = out.join(decided.select(*here, F.col("copies").alias(f"copies{level}")), here, "left")
    copies = sum(F.coalesce(f"copies{i}", F.lit(0)) for i in range(1, LEVELS + 1))
    return out.select(
        F.col("key").alias(key),
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, copies).otherwise(0).alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def op10(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("copies")


SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \\x09-\\x0D]+')), 0)::BIGINT AS size,
         substr(md5(concat_ws(':', 'mix', doc_id::VARCHAR)), 1, 9) AS p
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, source_size * 3 AS most,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM src),
rates AS (
  SELECT *, row_number() OVER o AS place,
         (sum(source_size) OVER () - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate
  FROM ranked WINDOW o AS (ORDER BY most / weight, source NULLS LAST)),
targets AS (
  SELECT source, source_size,
         least((SELECT rate FROM rates WHERE rate * weight <= most ORDER BY place LIMIT 1) * weight, most::DOUBLE) AS target
  FROM rates),
buckets AS (
  SELECT source, p, sum(size)::BIGINT AS bucket,
         (sum(sum(size)) OVER (PARTITION BY source ORDER BY p))::BIGINT AS after
  FROM sized GROUP BY source, p),
decided AS (
  SELECT b.source, b.p, t.source_size, t.target,
         (SELECT count(*) FROM (SELECT unnest([1, 2, 3]) AS k) ks
          WHERE b.after <= greatest(0.0, least(t.source_size::DOUBLE, t.target - (k - 1) * t.source_size))
             OR (b.after - b.bucket < greatest(0.0, least(t.source_size::DOUBLE, t.target - (k - 1) * t.source_size))
                 AND 2 * greatest(0.0, least(t.source_size::DOUBLE, t.target - (k - 1) * t.source_size))
                     >= b.after - b.bucket + b.after)) AS copies
  FROM buckets b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source)
SELECT s.doc_id, s.size, d.source_size, d.target, (s.size * d.copies)::BIGINT AS taken
FROM sized s JOIN decided d ON s.source IS NOT DISTINCT FROM d.source AND s.p = d.p
"""

QUERIES = {"op10_mix_sources": (op10, SQL)}
