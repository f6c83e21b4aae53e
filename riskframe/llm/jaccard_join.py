"""Exact similarity join of documents as sets of word shingles, in the metric space of Jaccard
distances.

Cells are pairs of shingles that follow each other within a set, in a fixed order of all shingles.  Of two sets
within a distance of 0.15, at most 15 % of either are missing in the other; a missing shingle
parts two such pairs and an additional one parts one, so the first pair that both have is among
the first 30 % of each.  A document lies in the cells of these.  Unrelated documents may share a
shingle by chance, but hardly two neighbours, so cells hold relatives and shared passages; shingles
that a bounded sample finds in several documents come last in the order, which leaves most
passages out.  Any order gives the same links.

The members of a cell gather around one document of it, the inner pivot; all cells with the same
inner pivot are one region.  Documents within the threshold of the pivot are linked to it and so
to each other.  The others are compared with those that the triangle inequality allows: their
distances to the pivot may differ by the threshold at most.  Large regions are cut into tiles.
Distances are exact, so the links are those of the full comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import components, materialize, table

WORDS = 4
SLAB = 1 << 19  # bytes hashed at once; a task needs some fifty times that
PARCEL = 1 << 22  # bytes of sets handed on at once
BLOCK = 512  # documents of a region in one task
BROADCAST_ROWS = 1_000_000  # lines of keys that may be sent to every executor
ID_BYTES = 5  # bytes of a shingle's hash that are kept in a set
_mix = np.random.default_rng(4).integers(1 << 62, size=256 + 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE, PLACE = _mix[:256].copy(), _mix[256:].copy()
BYTE[65:91] = BYTE[97:123]  # A-Z count as a-z
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a byte buffer, and where they start."""
    blank = BLANK[raw]
    edge = np.diff(blank, prepend=True, append=True)
    edges = np.flatnonzero(edge)
    begin, end = edges[::2], edges[1::2]
    if not len(begin):
        return np.zeros(0, np.uint64), begin
    length = end - begin
    powers = np.cumprod(np.full(int(length.max()), BASE))
    letters = np.flatnonzero(~blank)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(length) - length, length)
    sums = np.add.reduceat(BYTE[raw[letters]] * powers[place], np.cumsum(length) - length)
    return mixed(sums + length.astype(np.uint64)), begin


def slabs(texts: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Texts put together into buffers, a blank after each: (their numbers, bytes, starts)."""
    held, size = [], 0
    for i, t in enumerate(texts):
        held.append(i)
        size += len(t) + 1
        if size >= SLAB or i == len(texts) - 1:
            own = [texts[k] for k in held]
            starts = np.cumsum([0, *(len(t) + 1 for t in own)])[:-1]
            yield held, np.frombuffer(b" ".join(own) + b" ", np.uint8), starts
            held, size = [], 0


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    for numbers, raw, starts in slabs(texts):
        hashes, begin = word_hashes(raw)
        first = np.searchsorted(begin, starts)
        count = np.diff(np.r_[first, len(begin)])
        rolled = np.zeros(max(0, len(hashes) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            rolled += hashes[k : k + len(rolled)] * PLACE[k]
        rolled = mixed(rolled)
        for number, a, n in zip(numbers, first, count):
            if n >= WORDS:
                out[number] = np.unique(rolled[a : a + n - WORDS + 1])
            elif n:
                parts = np.r_[hashes[a : a + n] * PLACE[:n], PLACE[WORDS + n - 1 : WORDS + n]]
                out[number] = mixed(parts.sum(dtype=np.uint64, keepdims=True))
    return out


def prefix(own: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The first places of a set in the order of all shingles, sorted.  A place is whether the
    shingle is common, then 63 bits of its hash.

    Two sets within the threshold share a pair of neighbours among these; the begin of the order
    and the first place are a pair, too.  Let x shingles of A be missing in B and y of B in A,
    before the first pair that both have.  Each of the x parts at most two pairs of A and each of
    the y one, so at most 2x + y pairs of A come before it.  The threshold bounds x by (1 - t) of
    A where y is 0, and y costs more of it than it adds, so that is 2 (1 - t) of A at most;
    likewise in B.  For a threshold over one half a set always has one pair more."""
    place = own >> np.uint64(1)
    if len(own) and len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        place |= (common[at] == own).astype(np.uint64) << np.uint64(63)
    return np.sort(place)[: 2 * (100 - percent) * len(own) // 100 + 1]


def cell_ids(places: str) -> Column:
    """Hashes of the neighbours of a prefix, the first place counting as neighbour of the begin."""
    own, more = F.col(places), F.greatest(F.size(places) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(own, 1, more), F.slice(own, 2, more), lambda a, b: F.xxhash64(a, b))
    return F.concat(F.transform(F.slice(own, 1, 1), lambda a: F.xxhash64(a)), pairs)


def may_link(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """Whether two prefixes leave room for the threshold.

    Up to the place where the first of them ends both sets are known in full, so what only one of
    them has there is part of their difference.  Unrelated sets differ in nearly all of it."""
    if 100 * min(n_a, n_b) < percent * max(n_a, n_b):
        return False
    end = min(a[-1], b[-1])
    a, b = a[: np.searchsorted(a, end, "right")], b[: np.searchsorted(b, end, "right")]
    return (len(a) + len(b) - 2 * shared_count(a, b)) * (100 + percent) <= (n_a + n_b) * (100 - percent)


def packed(own: np.ndarray) -> bytes:
    """A set as sorted short ids."""
    ids = np.unique(own >> np.uint64(64 - 8 * ID_BYTES))
    return np.ascontiguousarray(ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ID_BYTES]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, ID_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :ID_BYTES] = raw
    return wide.view("<u8").ravel()


def shared_count(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


class Links:
    """Which members of a region are tied together."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def tie(self, a: int, b: int) -> None:
        self.up[self.top(a)] = self.top(b)


def lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column as arrays, without Python numbers in between."""
    values = column.flatten().to_numpy()
    ends = np.cumsum(column.value_lengths().to_numpy())
    return np.split(values, ends[:-1]) if len(ends) else []


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def _encoded(values) -> list[bytes]:
    return [(v or "").encode() for v in values]


def common_shingles(docs: DataFrame, rows: int, most: int) -> np.ndarray:
    """Shingles of two or more of at most ``rows`` sampled documents with different sets, the
    most frequent ``most`` of them, sorted."""
    count = docs.count()
    part = min(1.0, 1.5 * rows / max(1, count))
    spread = F.xxhash64("key", F.lit("sample"))
    near = docs.where(F.pmod(spread, F.lit(1 << 24)) <= int(part * (1 << 24)))
    sample = near.limit(rows) if part >= 1 else near.orderBy(spread).limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            sets = shingle_sets(_encoded(batch.column("text").to_pylist()))
            ids = [int(s.sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            yield pa.record_batch([pa.array(np.repeat(ids, [len(s) for s in sets]).astype(np.int64)), pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))], ["own", "shingle"])

    seen = sample.mapInArrow(run, "own long, shingle long").distinct().groupBy("shingle").count().where("count >= 2")
    top = seen.orderBy(F.desc("count"), "shingle").limit(most).toArrow()
    return np.sort(top.column("shingle").to_numpy().view(np.uint64))


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, sample_rows: int = 16_000, most_common: int = 500_000
) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a Jaccard similarity of
    ``percent`` / 100 or more.

    Returns key, n_shingles and component_id (smallest key reachable by links, itself included),
    one row per input row.  A to Z is lower-cased and words are cut at blanks; a text of fewer
    words is one shingle; texts without words are linked with nothing.  Rows with one key are
    compared each by its own text and count as linked with each other; a null key is linked with
    nothing and has a null component.  Other columns are ignored; an empty table gives an empty
    result.

    ``sample_rows`` and ``most_common`` bound what is learnt about frequent shingles; they change
    how much is compared, never the links.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    known_key = F.col("key").isNotNull()
    if rows.where(known_key).groupBy("key").count().where("count > 1").isEmpty():
        known, edges = _links(rows, percent, sample_rows, most_common)
        found = components(edges, "jaccard")
        return known.join(found, known["key"] == found["node"], "left").select(
            F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component_id")
        )
    # rows are numbered, and those of one key tied
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "jaccard-rows")
    known, edges = _links(rows.select(F.when(known_key, F.col("row")).alias("key"), "text"), percent, sample_rows, most_common)
    keyed = rows.where(known_key).select("row", F.col("key").alias("own"))
    first = keyed.groupBy(F.col("own").alias("same_own")).agg(F.min("row").alias("b"))
    ties = keyed.join(first, F.col("own") == F.col("same_own")).select(F.col("row").alias("a"), "b")
    found = components(edges.unionByName(ties), "jaccard")
    named = keyed.join(known.select(F.col("key").alias("row"), "n"), "row").join(found, F.col("row") == F.col("node"), "left")
    named = named.withColumn("component", F.coalesce("component", "row"))
    least = named.groupBy("component").agg(F.min("own").alias("least"))
    bare = known.where("key is null").select(F.lit(None).cast("long").alias(key), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return named.join(least, "component").select(F.col("own").alias(key), F.col("n").alias("n_shingles"), F.col("least").alias("component_id")).unionByName(bare)


def _links(rows: DataFrame, percent: int, sample_rows: int, most_common: int) -> tuple[DataFrame, DataFrame]:
    """(key, n, same, prefix) of every row, and links (a, b) that join all that is linked; keys
    that are not null differ."""
    spark = rows.sparkSession
    common = spark.sparkContext.broadcast(common_shingles(rows, sample_rows, most_common))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            sets = shingle_sets(_encoded(batch.column("text").to_pylist()))
            keys = batch.column("key").to_pylist()
            seen: dict[bytes, int] = {}
            same, first = [], []
            for k, s in zip(keys, sets):
                # equal sets of a batch: only the first goes on, the others are linked to it
                twin = seen.setdefault(s.tobytes(), k) if k is not None and len(s) else None
                same.append(twin if twin != k else None)
                goes = k is not None and len(s) and twin == k
                first.append(prefix(s, common.value, percent).view(np.int64) if goes else np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, first)]), pa.int32()), pa.array(np.concatenate([*first, np.zeros(0, np.int64)])))
            yield pa.record_batch([batch.column("key"), pa.array([len(s) for s in sets], pa.int64()), pa.array(same, pa.int64()), lists], ["key", "n", "same", "prefix"])

    known = materialize(rows.mapInArrow(cells, "key long, n long, same long, prefix array<long>"), "jaccard-cells")

    # inner pivots: the smallest document of a cell; a partial aggregate, so a frequent pair is
    # combined in the tasks
    members = known.select("key", F.explode(cell_ids("prefix")).alias("cell"))
    pivots = members.groupBy("cell").agg(F.min("key").alias("pivot"), F.max("key").alias("last")).where("pivot < last").select("cell", "pivot")
    regions = members.join(pivots, "cell").where("key <> pivot").select("key", "pivot").distinct()
    regions = materialize(regions, "jaccard-regions")

    # prefixes alone rule out most members: first against the pivot, then against each other
    def by_prefix(batch: pa.RecordBatch) -> list[bytes]:
        return [v.tobytes() for v in lists(batch.column("value"))]

    def by_pivot(own: bytes, n_own: int, other: bytes, n: int) -> int:
        return int(may_link(np.frombuffer(own, np.uint64), np.frombuffer(other, np.uint64), n_own, n, percent))

    prefixes = known.where(F.size("prefix") > 0).select("key", "n", F.col("prefix").alias("value"))
    judged = _beside_pivot(prefixes, regions, by_prefix, by_pivot).select("pivot", "key", F.col("shared").alias("near"))
    judged = materialize(judged.where("key <> pivot"), "jaccard-judged")
    apart = judged.groupBy("pivot").agg(F.count("*").alias("size"), F.min("near").alias("near")).where("size > 1 and near = 0").select("pivot")
    inside = judged.join(apart, "pivot")
    tiles = _tiles(_carried(prefixes, inside), ["key", "n", "near", "value"])

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members away from the pivot that may link with another member, and those others."""
        for rows in grouped(batches, TILE):
            key, n, near, part = (rows.column(c).to_numpy() for c in ("key", "n", "near", "part"))
            own = [v.view(np.uint64) for v in lists(rows.column("value").combine_chunks())]
            two = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
            alive = np.zeros(len(key), bool)
            for i in np.flatnonzero(near == 0):
                # every partner stays, unless it is known to stay already
                fits = (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & (np.arange(len(key)) != i)
                fits &= (part != part[i]) if two else True
                if alive[i]:
                    fits &= ~alive & (near == 0)
                for j in np.flatnonzero(fits):
                    if alive[i] and (alive[j] or near[j]):
                        continue
                    if may_link(own[i], own[j], n[i], n[j], percent):
                        alive[i] = alive[j] = True
            if alive.any():
                yield pa.record_batch([pa.array(key[alive]), pa.array(rows.column("pivot").to_numpy()[alive])], ["key", "pivot"])

    regions = judged.where("near = 1").select("key", "pivot").unionByName(tiles.mapInArrow(partners, "key long, pivot long")).distinct()
    regions = materialize(regions, "jaccard-alive")

    def by_text(batch: pa.RecordBatch) -> list[bytes]:
        return [packed(s) for s in shingle_sets(_encoded(batch.column("value").to_pylist()))]

    def by_set(own: bytes, n_own: int, other: bytes, n: int) -> int:
        return shared_count(unpacked(own), unpacked(other))

    measured = _beside_pivot(rows.where(F.col("key").isNotNull()).select("key", F.col("text").alias("value")), regions, by_text, by_set)
    # kept with their sets until it is known which regions have documents beyond the threshold
    measured = materialize(measured, "jaccard-measured")
    own_size = measured.where("key = pivot").select("pivot", F.col("n").alias("pivot_n")).distinct()
    measured = measured.where("key <> pivot").join(own_size, "pivot")
    alike = 100 * F.col("shared") >= percent * (F.col("n") + F.col("pivot_n") - F.col("shared"))
    measured = measured.withColumn("linked", alike).withColumn("distance", 1 - F.col("shared") / (F.col("n") + F.col("pivot_n") - F.col("shared")))
    beyond = measured.where(~F.col("linked")).groupBy("pivot").agg(F.count("*").alias("beyond"), F.min("distance").alias("nearest"))
    # triangle inequality: linked members too near to the pivot are out of reach for all beyond
    reach = 1 - percent / 100 + 1e-9
    left = measured.join(beyond, "pivot").where(~F.col("linked") | (F.col("distance") >= F.col("nearest") - reach))
    ready = _tiles(left, ["key", "n", "linked", "distance", "ids"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, TILE):
            a, b = region_links(rows, percent, reach)
            if len(a):
                yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    edges = (
        known.where(F.col("same").isNotNull()).select(F.col("key").alias("a"), F.col("same").alias("b"))
        .unionByName(measured.where("linked").select(F.col("key").alias("a"), F.col("pivot").alias("b")))
        .unionByName(ready.mapInArrow(compare, "a long, b long"))
    )
    return known, edges


TILE = ["pivot", "low", "high"]


def _carried(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows (by key) with each of their lines in ``regions``.  The lines go to the rows where
    they are few by count; both sides are shuffled otherwise."""
    return rows.join(F.broadcast(regions) if regions.count() <= BROADCAST_ROWS else regions, "key")


def _beside_pivot(rows: DataFrame, regions: DataFrame, encode: Callable, measure: Callable) -> DataFrame:
    """pivot, block, key, n, ids and shared, for every member of ``regions`` and every pivot.

    ``rows``: key, value and perhaps n; ``encode`` gives the values of a batch as bytes and
    ``measure`` compares the pivot's with a member's.  A region has as many blocks as it needs,
    and its pivot is in each of them, so a huge region spreads over many tasks."""
    every = regions.select("key", "pivot").unionByName(regions.select(F.col("pivot").alias("key"), "pivot").distinct())
    sizes = regions.groupBy("pivot").count().select("pivot", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    wanted = every.join(sizes, "pivot").groupBy("key").agg(F.collect_list(F.struct("pivot", "blocks")).alias("regions"))
    wanted = materialize(wanted, "jaccard-wanted")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            keys, asked = batch.column("key").to_pylist(), batch.column("regions").to_pylist()
            data = encode(batch)
            sizes = batch.column("n").to_pylist() if "n" in batch.schema.names else [len(d) // ID_BYTES for d in data]
            out = []
            for k, n, d, own in zip(keys, sizes, data, asked):
                for r in own:
                    blocks = range(r["blocks"]) if r["pivot"] == k else [hash(k) % r["blocks"]]
                    out += [(r["pivot"], b, k, n, d) for b in blocks]
            ends = np.cumsum([len(row[-1]) + 28 for row in out]) // PARCEL
            for part in np.split(np.arange(len(out)), np.flatnonzero(np.diff(ends)) + 1) if out else ():
                columns = list(zip(*out[part[0] : part[-1] + 1]))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["pivot", "block", "key", "n", "ids"])

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pivot comes first in its group; every member is measured against it."""
        at, own, n_own = None, b"", 0
        for batch in batches:
            pivot, block, n = (batch.column(c).to_numpy() for c in ("pivot", "block", "n"))
            data = batch.column("ids").to_pylist()
            shared = np.zeros(len(pivot), np.int64)
            for i in range(len(pivot)):
                if at != (pivot[i], block[i]):
                    at, own, n_own = (pivot[i], block[i]), data[i], int(n[i])
                shared[i] = measure(own, n_own, data[i], int(n[i]))
            yield batch.append_column("shared", pa.array(shared))

    schema = "pivot long, block int, key long, n long, ids binary"
    spread = _carried(rows, wanted).mapInArrow(placed, schema).repartition("pivot", "block")
    return spread.sortWithinPartitions("pivot", "block", (F.col("key") != F.col("pivot")), "key").mapInArrow(beside, f"{schema}, shared long")


def _tiles(members: DataFrame, columns: list[str]) -> DataFrame:
    """Members of regions dealt out by pairs of blocks (low, high), grouped and sorted."""
    parts = members.groupBy("pivot").count().select("pivot", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
    tiles = members.join(parts, "pivot").withColumn("part", F.pmod(F.xxhash64("key", F.lit(1)), F.col("parts")).cast("int"))
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = tiles.select("pivot", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", *columns)
    return tiles.repartition(*TILE).sortWithinPartitions(*TILE, "key")


def grouped(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Whole groups of sorted rows, one after the other."""
    held: list[pa.Table] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(c).to_numpy() for c in columns]
        cuts = np.flatnonzero(np.r_[True, np.logical_or.reduce([v[1:] != v[:-1] for v in values])])
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
            here = tuple(v[a] for v in values)
            if here != at and held:
                yield pa.concat_tables(held)
                held = []
            at = here
            held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
    if held:
        yield pa.concat_tables(held)


def region_links(rows: pa.Table, percent: int, reach: float) -> tuple[list[int], list[int]]:
    """Links among the members of a tile of which at least one lies beyond the pivot's reach.

    Members within reach are tied by the pivot; what is tied already is not compared again.
    Sizes and distances to the pivot rule out most of the rest."""
    key, n, linked, distance, part = (rows.column(c).to_numpy() for c in ("key", "n", "linked", "distance", "part"))
    sets = [unpacked(b) for b in rows.column("ids").to_pylist()]
    tied, a, b = Links(len(key) + 1), [], []
    for i in np.flatnonzero(linked):
        tied.tie(int(i), len(key))
    two = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
    for i in np.flatnonzero(~linked):
        fits = (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & (np.abs(distance - distance[i]) <= reach)
        fits &= linked | (np.arange(len(key)) > i)
        if two:
            fits &= part != part[i]
        other = np.flatnonzero(fits)
        for j in other[np.argsort(np.abs(distance[other] - distance[i]), kind="stable")]:
            if tied.top(int(j)) != tied.top(int(i)):
                shared = shared_count(sets[i], sets[j])
                if 100 * shared >= percent * (n[i] + n[j] - shared):
                    tied.tie(int(i), int(j))
                    a.append(int(key[i]))
                    b.append(int(key[j]))
    return a, b


def op4(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


COMPONENTS_SQL = r"""
jd AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM {docs}),
js AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM jd WHERE len(w) > 0)),
jn AS (SELECT doc_id, count(*) AS n FROM js GROUP BY doc_id),
ji AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM js a JOIN js b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
jl AS (SELECT a, b FROM ji JOIN jn x ON x.doc_id = a JOIN jn y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
jr AS (SELECT a, b FROM jl UNION SELECT jr.a, jl.b FROM jr JOIN jl ON jr.b = jl.a),
jc AS (SELECT a, least(a, min(b)) AS c FROM jr GROUP BY a)
"""
SQL = (
    "WITH RECURSIVE "
    + COMPONENTS_SQL.format(docs="documents")
    + """
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, doc_id) AS component_id
FROM documents LEFT JOIN jn USING (doc_id) LEFT JOIN jc ON jc.a = doc_id
"""
)

QUERIES = {"op4_jaccard_components": (op4, SQL)}
