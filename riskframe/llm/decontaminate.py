"""Benchmark decontamination by item-sized windows.

All windows of an item's length are weighed by the shingles they share with it: an occurrence
counts for the windows of one stretch of beginnings, so sums of these stretches tell every window
without cutting it out.  The best window of a text and an item gets a SimHash.  Fingerprints are
compared through a multi-index: with more blocks than the radius has bits, two fingerprints within
the radius agree on a whole block, so none is missed.  Fingerprints farther apart discard a pair
only where they prove that it is not similar enough: where a bit differs that the item's shingles
vote for too clearly.  What is left is decided by the exact similarity of the weighted shingles (a
shingle weighs as often as it occurs).  Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.shared import ascii_lower, materialize, table, words

WIDTH = 5
BITS = 64
BROADCAST_ROWS = 500_000  # item shingles, 24 bytes each, that may be sent to every executor


def starts(tokens: Column, width: Column) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.size(tokens) - width + 1, F.lit(1)))


def hashes(tokens: Column, width: Column) -> Column:
    """64-bit hash of every shingle; a text with fewer words is one shingle."""
    return F.transform(starts(tokens, width), lambda i: F.xxhash64(F.slice(tokens, i, width)))


def counted(tokens: Column, width: Column) -> Column:
    """Every shingle with the number of its occurrence, so that the set of these says how often
    each occurs.  Equal shingles are neighbours once sorted: as long as a sort takes.  Arrays that
    a lambda reads are bound to a name first, or each of its calls would make them anew."""
    shingles = F.transform(starts(tokens, width), lambda i: F.array_join(F.slice(tokens, i, width), " "))
    bound = lambda array, work: F.get(F.transform(F.array(array), work), F.lit(0))

    def numbered(s: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return bound(first, lambda at: F.flatten(F.transform(at, lambda p, j: copies(s, p, F.coalesce(F.get(at, j + 1), F.size(s)) - p))))

    def copies(s: Column, place: Column, n: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), n), lambda k: F.concat(F.get(s, place), F.lit("\n"), k.cast("string")))

    return bound(F.sort_array(shingles), numbered)


def simhash(own: str) -> Column:
    """SimHash of an array of 64-bit hashes (name of the column), each counted as often as it occurs."""
    return F.expr(
        f"aggregate(sequence(0, {BITS - 1}), 0L, (acc, b) -> acc | if("
        f"2 * aggregate({own}, 0, (n, h) -> n + cast(shiftright(h, b) & 1L as int)) >= size({own}), shiftleft(1L, b), 0L))"
    )


def firm(own: str, percent: int) -> Column:
    """The bits that the SimHash of an item of these hashes shares with that of every window of
    ``percent`` similarity.  The window is no longer than the item; so, of ``size`` shingles, at most
    2 * size * (100 - percent) / (100 + percent) are in one of the two only, each moves the votes
    for a bit, ones less zeros, by one, and votes beyond that keep their sign."""
    return F.expr(
        f"aggregate(sequence(0, {BITS - 1}), 0L, (acc, b) -> acc | if("
        f"{100 + percent}L * abs(2 * aggregate({own}, 0, (n, h) -> n + cast(shiftright(h, b) & 1L as int)) - size({own}))"
        f" > {2 * (100 - percent)}L * size({own}), shiftleft(1L, b), 0L))"
    )


def blocks(fingerprint: Column, radius: int) -> Column:
    """radius + 1 blocks of bits: (number, value)."""
    n = radius + 1
    edges = [BITS * i // n for i in range(n + 1)]
    return F.array(
        *[
            F.struct(F.lit(i).alias("number"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
            for i, (a, b) in enumerate(zip(edges, edges[1:]))
        ]
    )


def best_windows(hits: DataFrame, percent: int) -> DataFrame:
    """Per text (key, id) and item the first window that shares most with the item, where that can
    reach ``percent``: (key, id, item, n, width, begin).

    ``hits``: key, id, size, item, of, n, width, c, hash, at; the shingle begins at the places ``at``
    of the text and stands ``c`` times in the item.  A window that begins at b shares the
    occurrences of a shingle inside it, c at most.  So the one at p counts where the window
    reaches p and the c-th occurrence before p lies outside: for one stretch of beginnings.
    """
    span = F.least("n", "size") - F.col("width") + 1  # shingles of a window
    last = F.greatest(F.col("size") - F.col("n"), F.lit(0))  # the last beginning inside the text
    passed = lambda i: F.when(i >= F.col("c"), F.get("at", (i - F.col("c")).cast("int")) + 1).otherwise(0)
    stretch = F.transform("at", lambda p, i: F.struct(F.greatest(p - span + 1, passed(i)).alias("lo"), F.least(p, last).alias("hi")))
    ends = F.flatten(
        F.transform(
            F.filter(stretch, lambda x: x["lo"] <= x["hi"]),
            lambda x: F.array(F.struct(x["lo"].alias("begin"), F.lit(1).alias("step")), F.struct((x["hi"] + 1).alias("begin"), F.lit(-1).alias("step"))),
        )
    )
    own = ["key", "id", "size", "item", "of", "n", "width"]
    steps = hits.select(*own, F.explode(ends).alias("x")).groupBy(*own, F.col("x.begin").alias("begin")).agg(F.sum("x.step").alias("step"))
    shared = steps.withColumn("shared", F.sum("step").over(Window.partitionBy(*own).orderBy("begin")))
    best = shared.groupBy(*own).agg(F.max(F.struct("shared", (-F.col("begin")).alias("back"))).alias("best"))
    whole = span + F.col("n") - F.col("width") + 1
    reached = (100 + percent) * F.col("best.shared") >= percent * whole
    return best.where(reached).select("key", "id", "item", "n", "width", (-F.col("best.back")).alias("begin"))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    radius: int = 24,
    percent: int = 80,
) -> DataFrame:
    """Benchmark items found in each document.

    Returns key, n_items, items (sorted array of item ids), one row per distinct key that has a
    window with at least ``percent`` similarity to an item.  Words are cut at blanks, A to Z is
    lower-cased, shingles have five words; an item of fewer words is one shingle and matches
    where its words stand in a row.  Windows are as long as the item (or the whole text, if that
    is shorter) and begin at any word; per text and item the one that shares most is compared.  At
    80 % similarity fingerprints differ in about 10 of 64 bits; ``radius`` 24 is five standard
    deviations above.  Texts of few different shingles differ in more; they are told by firm bits,
    so no pair of ``percent`` similarity is lost.

    Null and empty texts match nothing, nor do items without words; null keys match like others
    (together), and so do items without an id (as one item, null); repeated rows count once; other
    columns are ignored; empty tables give no rows.
    """
    items = (
        benchmark.select(F.col(item).alias("item"), words(ascii_lower(F.col(item_text))).alias("w"))
        .where(F.size("w") > 0)
        .distinct()
        .withColumn("width", F.least(F.lit(WIDTH), F.size("w")))
    )
    # rows of one item id with different texts stay apart
    shingles = items.select("item", F.xxhash64("w").alias("of"), F.size("w").alias("n"), "width", F.explode(hashes(F.col("w"), F.col("width"))).alias("hash"))
    shingles = materialize(shingles.groupBy("item", "of", "n", "width", "hash").agg(F.count("*").cast("int").alias("c")), "leak-shingles")
    widths = sorted(r["width"] for r in shingles.select("width").distinct().collect())  # 1 to 5
    probes = F.broadcast(shingles) if shingles.count() <= BROADCAST_ROWS else shingles

    tokens = docs.select(F.col(key).alias("key"), words(ascii_lower(F.col(text))).alias("w"))
    hits = None
    for width in widths:
        own = tokens.where(F.size("w") >= width).select(
            "key", F.xxhash64("w").alias("id"), F.size("w").alias("size"), F.posexplode(hashes(F.col("w"), F.lit(width))).alias("pos", "hash")
        )
        found = own.join(probes.where(F.col("width") == width), "hash")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return docs.select(key, F.lit(0).cast("long").alias("n_items"), F.array(F.lit(None).cast(dict(benchmark.dtypes)[item])).alias("items")).limit(0)
    shingle = ["key", "id", "size", "item", "of", "n", "width", "c", "hash"]
    hits = hits.groupBy(*shingle).agg(F.sort_array(F.collect_set("pos")).alias("at"))
    best = materialize(best_windows(hits, percent), "leak-best")

    asked = best.groupBy(F.col("key").alias("k"), F.col("id").alias("of_text")).agg(F.collect_set(F.struct("item", "n", "width", "begin")).alias("windows"))
    inside = tokens.join(asked, F.col("key").eqNullSafe(F.col("k")) & (F.xxhash64("w") == F.col("of_text"))).select(
        "key", F.explode(F.transform("windows", lambda x: F.struct(x["item"].alias("item"), x["width"].alias("width"), F.slice("w", x["begin"] + 1, x["n"]).alias("w")))).alias("x")
    )
    windows = inside.select("key", "x.*").withColumn("own", hashes(F.col("w"), F.col("width"))).withColumn("print", simhash("own"))
    windows = materialize(windows.select("key", "item", "width", "w", "print").distinct(), "leak-windows")
    prints = items.withColumn("own", hashes(F.col("w"), F.col("width"))).withColumn("item_print", simhash("own")).withColumn("firm", firm("own", percent))
    prints = materialize(prints.select(F.col("item").alias("of_item"), "item_print", "firm", F.col("w").alias("item_w")), "leak-prints")

    split = lambda df, c, name: df.select("*", F.explode(blocks(F.col(c), radius)).alias(name))
    of = F.col("item").eqNullSafe(F.col("of_item"))
    differ = F.col("print").bitwiseXOR(F.col("item_print"))
    ours, theirs = windows.select("key", "item", "print"), prints.select("of_item", "item_print", "firm")
    near = split(ours, "print", "block").join(split(theirs, "item_print", "of_block"), of & (F.col("block") == F.col("of_block")))
    near = near.where(F.bit_count(differ) <= radius)
    beyond = ours.join(theirs, of).where((F.bit_count(differ) > radius) & (differ.bitwiseAND(F.col("firm")) == 0))
    found = near.select("key", "item", "print").union(beyond.select("key", "item", "print")).distinct().toDF("k", "found_item", "found_print")
    pairs = windows.join(found, F.expr("key <=> k and item <=> found_item and print = found_print")).select("key", "item", "width", "w")
    both = pairs.join(prints, of).select("key", "item", counted(F.col("w"), F.col("width")).alias("a"), counted(F.col("item_w"), F.col("width")).alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    alike = both.where(100 * shared >= percent * (F.size("a") + F.size("b") - shared))
    leaks = alike.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("item"))).alias("found"))  # a set of bare ids would lose null
    return leaks.select(F.col("key").alias(key), F.size("found").cast("long").alias("n_items"), F.col("found.item").alias("items"))


def marked(docs: DataFrame, leaks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every document with contaminated, n_items and items, in place of columns of these names."""
    docs = docs.drop("contaminated", "n_items", "items")
    found = leaks.select(F.col(key).alias("__k"), "n_items", "items")
    own = [F.col(f"`{c}`") for c in docs.columns]
    return docs.join(found, F.col(key).eqNullSafe(F.col("__k")), "left").select(
        *own, F.col("items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "items"
    )


def op5(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = table(spark, sf_dir, "benchmark").where(F.col("item_id").isNotNull())  # the SQL finds items by their ids
    found = marked(docs.select("doc_id"), find_leaks(docs, named))
    return found.select("doc_id", "contaminated", "n_items", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


LEAKS_SQL = r"""
d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM {docs}),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM benchmark),
bs AS (SELECT item_id, len(w) AS n, least(5, len(w)) AS k, unnest(range(1, greatest(len(w) - 3, 2))) AS i, w FROM b WHERE len(w) > 0),
bp AS (SELECT item_id, n, k, i - 1 AS off, array_to_string(w[i : i + k - 1], ' ') AS s FROM bs),
ks AS (SELECT DISTINCT k FROM bp),
dp AS (SELECT doc_id, k, i - 1 AS pos, len(w) AS size, array_to_string(w[i : i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
win AS (SELECT DISTINCT doc_id, item_id, n, bp.k, greatest(0, least(pos - off, size - n)) AS b0 FROM dp JOIN bp ON dp.s = bp.s AND dp.k = bp.k),
ww AS (SELECT win.*, d.w[b0 + 1 : b0 + n] AS w FROM win JOIN d USING (doc_id)),
wc AS (SELECT doc_id, item_id, b0, s, count(*) AS c FROM (
         SELECT doc_id, item_id, b0, array_to_string(w[i : i + k - 1], ' ') AS s
         FROM (SELECT *, unnest(range(1, greatest(len(w) - k + 2, 2))) AS i FROM ww)) GROUP BY ALL),
bc AS (SELECT item_id, s, count(*) AS c FROM bp GROUP BY ALL),
sums AS (SELECT doc_id, item_id, b0, sum(wc.c) AS a, sum(least(wc.c, coalesce(bc.c, 0))) AS shared FROM wc LEFT JOIN bc USING (item_id, s) GROUP BY ALL),
leaks AS (SELECT doc_id, item_id FROM sums JOIN (SELECT item_id, sum(c) AS b FROM bc GROUP BY ALL) USING (item_id)
          WHERE 100 * shared >= 80 * (a + b - shared) GROUP BY ALL)
"""
SQL = (
    "WITH "
    + LEAKS_SQL.format(docs="documents")
    + """
SELECT doc_id, n IS NOT NULL AS contaminated, coalesce(n, 0)::BIGINT AS n_items, items
FROM documents LEFT JOIN (
  SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items FROM leaks GROUP BY doc_id) USING (doc_id)
"""
)

QUERIES = {"op5_benchmark_leaks": (op5, SQL)}
