"""Near-duplicate vectors by randomly rotated binary codes.

A unit vector is rotated at random; the signs of its coordinates are its code, and the inner
product of the vector with its own code is stored as a correction factor.  The code's inner
product with another vector, divided by that factor, estimates their cosine without bias, and
the factor also bounds the error.  Several rotations are averaged.

Candidates come from other bits.  Every table has random planes of its own, and vectors on the
same side of all of them share a bucket; enough tables are made that a pair at the threshold meets
in one of them with high probability.  Tables are independent, so that probability is a product.
Inside a bucket estimate and bound of the code discard a pair, or the exact cosine decides.  A pair that
meets several times counts in the first table where it does, so links are counted without ever
being written out, and a bucket hands on one link per vector, to the smallest one it is tied to.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import components, materialize, table

BLOCK = 1024  # vectors of a bucket that are compared in one piece
SMALL = 32  # buckets up to this size are compared together
CODE_BITS = 256


@dataclass
class Coder:
    """Rotations, the planes of every table, and the threshold, for vectors of one length."""

    dim: int
    tables: int
    bits: int
    least: float
    sure: float
    seed: int = 7

    def __post_init__(self):
        rng = np.random.default_rng([self.seed, self.dim])
        count = max(1, -(-CODE_BITS // self.dim))
        self.rotations = np.concatenate([np.linalg.qr(rng.standard_normal((self.dim, self.dim)))[0] for _ in range(count)], axis=1)
        self.count, self.width = count, count * self.dim
        # whole numbers, so that a vector is on the same side in every batch and on every machine
        self.planes = np.rint(rng.standard_normal((self.dim, self.tables * self.bits)) * (1 << 16)).astype(np.float32)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        return unit @ self.rotations >= 0

    def buckets(self, raw: np.ndarray) -> np.ndarray:
        """Key of every vector in every table.

        Components are rounded to 22 bits below the largest; sums of their products with the
        planes stay under 53 bits (up to some 30,000 dimensions), so their order is of no account."""
        powers, out = 1 << np.arange(self.bits, dtype=np.int64), []
        planes = self.planes.astype(np.float64)
        for part in (raw[i : i + 1024].astype(np.float64) for i in range(0, len(raw), 1024)):
            whole = np.rint(np.ldexp(part, 22 - np.frexp(np.abs(part).max(1))[1][:, None]))
            sides = (whole @ planes >= 0).reshape(len(part), self.tables, self.bits)
            out.append(sides @ powers)
        return np.concatenate(out) if out else np.zeros((0, self.tables), np.int64)

    def factors(self, unit: np.ndarray) -> np.ndarray:
        """Inner product with the own code, for every rotation."""
        parts = np.abs(unit @ self.rotations).reshape(len(unit), self.count, self.dim)
        return parts.sum(2) / math.sqrt(self.dim)

    def bound(self, factors: np.ndarray) -> np.ndarray:
        """``sure`` standard errors of the averaged estimate."""
        spread = (1 - factors**2) / factors**2 / max(1, self.dim - 1)
        return self.sure * np.sqrt(spread.sum(1)) / self.count

    def scaled(self, codes: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """Codes divided by their factors: times a rotated vector they give the estimate."""
        signs = np.where(codes, 1.0, -1.0).reshape(len(codes), self.count, self.dim)
        return (signs / (factors[:, :, None] * math.sqrt(self.dim) * self.count)).reshape(len(codes), -1)


def table_plan(vectors: int, least: float, missed: float) -> tuple[int, int]:
    """Bits a table, and tables, so that unrelated vectors rarely meet and a pair at the
    threshold stays apart in all tables with probability ``missed`` at most."""
    bits = min(60, max(6, math.ceil(math.log2(max(2, vectors))) - 2))
    same = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(missed) / math.log(1 - same))


def roots(n: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For local links a-b among n vectors: the smallest id that each is tied to."""
    low = ids.copy()
    while True:
        least = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        if (new == low).all():
            return low
        low = new


def _pairs_of_small(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs inside each of many small groups, as positions."""
    a, b = [], []
    for n in np.unique(size[size > 1]):
        i, j = np.triu_indices(int(n), 1)
        first = begin[size == n][:, None]
        a.append((first + i).ravel())
        b.append((first + j).ravel())
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _linked(coder: Coder, rows: dict[str, np.ndarray], begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions that are linked, out of groups of rows that lie together."""
    unit, factor = rows["unit"], rows["factor"]
    found = []

    def decide(a: np.ndarray, b: np.ndarray, estimate: np.ndarray) -> None:
        open_ = estimate + np.maximum(rows["bound"][a], rows["bound"][b]) >= coder.least
        a, b = a[open_], b[open_]
        for part in range(0, len(a), 1 << 16):
            x, y = a[part : part + (1 << 16)], b[part : part + (1 << 16)]
            cosine = np.einsum("ij,ij->i", rows["raw"][x], rows["raw"][y]) / (rows["norm"][x] * rows["norm"][y])
            found.append((x[cosine >= coder.least], y[cosine >= coder.least]))

    turned, scaled = unit @ coder.rotations, coder.scaled(rows["codes"], factor)
    a, b = _pairs_of_small(begin[size <= SMALL], size[size <= SMALL])
    for part in range(0, len(a), 1 << 15):
        x, y = a[part : part + (1 << 15)], b[part : part + (1 << 15)]
        decide(x, y, np.einsum("ij,ij->i", scaled[x], turned[y]))
    for at, n in zip(begin[size > SMALL], size[size > SMALL]):
        for i in range(at, at + n, BLOCK):
            for j in range(i, at + n, BLOCK):
                ends = min(i + BLOCK, at + n), min(j + BLOCK, at + n)
                estimate = scaled[i : ends[0]] @ turned[j : ends[1]].T
                x, y = np.nonzero(estimate + np.maximum(rows["bound"][i : ends[0], None], rows["bound"][None, j : ends[1]]) >= coder.least)
                ahead = (x + i) < (y + j)
                decide(x[ahead] + i, y[ahead] + j, estimate[x[ahead], y[ahead]])
    if not found:
        none = np.zeros(0, np.int64)
        return none, none
    return tuple(np.concatenate(p) for p in zip(*found))


def _compared(coder: Coder, batch: pa.RecordBatch, kind: np.dtype) -> pa.RecordBatch:
    """Links of whole groups (table, bucket, tile): node, others it links to, node it is tied to."""
    column = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
    raw = np.frombuffer(b"".join(batch.column("vector").to_pylist()), kind).reshape(-1, coder.dim).astype(np.float64)
    norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
    rows = {"raw": raw, "norm": norm, "unit": raw / norm[:, None]}
    rows["codes"] = np.unpackbits(np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(raw), -1), axis=1, count=coder.width).astype(bool)
    rows["factor"] = np.frombuffer(b"".join(batch.column("factors").to_pylist()), np.float32).reshape(len(raw), -1).astype(np.float64)
    rows["bound"] = coder.bound(rows["factor"])
    group = np.stack([column(c) for c in ("place", "bucket", "low", "high")])
    begin = np.flatnonzero(np.r_[True, (group[:, 1:] != group[:, :-1]).any(0)])
    size = np.diff(np.r_[begin, len(raw)])
    a, b = _linked(coder, rows, begin, size)
    # in a tile of two blocks only pairs across them are new
    low, high, part = column("low"), column("high"), column("part")
    across = (low[a] == high[a]) | (part[a] != part[b])
    a, b = a[across], b[across]
    # a pair counts in the first table in which it meets
    some = np.unique(np.r_[a, b])
    keys, at = coder.buckets(raw[some]), np.searchsorted(some, np.stack([a, b]))
    place = column("place")
    earlier = np.arange(coder.tables)[None, :] < place[a][:, None]
    new = np.concatenate([~((keys[at[0, i : i + 65536]] == keys[at[1, i : i + 65536]]) & earlier[i : i + 65536]).any(1) for i in range(0, len(a), 65536)] or [np.zeros(0, bool)])
    a, b = a[new], b[new]
    node, weight = column("node"), column("copies")
    links = np.bincount(a, weight[b], len(raw)) + np.bincount(b, weight[a], len(raw))
    tied = roots(len(raw), a, b, node) if len(a) else node
    some = links > 0
    return pa.record_batch([pa.array(node[some]), pa.array(links[some].astype(np.int64)), pa.array(tied[some])], ["node", "links", "tied"])


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95, missed: float = 0.001, sure: float = 5.0
) -> DataFrame:
    """Links and components of vectors with a cosine of ``least`` or more.

    Returns key, n_links (other rows linked directly), component_id (smallest key reachable by
    links, itself included) and kept (key = component_id), one row per input row.  Cosines are
    taken in double precision; a pair below ``least`` is never linked.  A pair at ``least`` is
    missed with a probability of about ``missed``, closer pairs far more rarely; a pair is given
    up without its cosine only when it lies ``sure`` standard errors below.

    Vectors that are null, zero or hold null or non-finite components link with nothing, nor do
    vectors of different lengths or rows with a null key (component null).  Equal vectors are
    compared once and count as often as they occur.  An empty table gives an empty result.

    A bucket with more than ``BLOCK`` vectors is cut into blocks by hash, and pairs of blocks
    are separate groups, so one huge group of near copies spreads over many tasks.
    """
    spark = vectors.sparkSession
    item = dict(vectors.dtypes)[vector]
    kind = np.dtype(np.float32) if item == "array<float>" else np.dtype(np.float64)
    value = F.col("v")
    usable = value.isNotNull() & F.col("id").isNotNull() & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>" if kind == np.float32 else "array<double>").alias("v"))
    usable_rows = rows.where(F.coalesce(usable, F.lit(False)))
    distinct = materialize(usable_rows.groupBy("v").agg(F.min("id").alias("node"), F.count("*").alias("copies")), "vectors")
    dims = {r["d"]: r["n"] for r in distinct.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}

    linked = None
    for dim, count in sorted(dims.items()):
        found = _links_of(distinct.where(F.size("v") == dim), dim, count, kind, least, missed, sure)
        linked = found if linked is None else linked.unionByName(found)
    schema = "node long, links long, tied long"
    linked = materialize(linked if linked is not None else spark.createDataFrame([], schema), "vector-links")

    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    tied = components(linked.select(F.col("node").alias("a"), F.col("tied").alias("b")), "vectors")
    nodes = distinct.join(counts, "node", "left").join(tied, "node", "left").select(
        "v", "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
    )
    known = usable_rows.join(nodes, "v").select("id", "n_links", "component_id")
    others = rows.where(~F.coalesce(usable, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return known.unionByName(others).select(
        F.col("id").alias(key), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )


def _links_of(distinct: DataFrame, dim: int, count: int, kind: np.dtype, least: float, missed: float, sure: float) -> DataFrame:
    bits, tables = table_plan(count, least, missed)
    coder = Coder(dim, tables, bits, least, sure)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                raw = batch.column("v").flatten().to_numpy().astype(kind).reshape(-1, dim)
                unit = raw.astype(np.float64)
                unit /= np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]
                codes, n = coder.codes(unit), len(raw)
                at = pa.array(np.repeat(np.arange(n), tables))
                stored = [
                    batch.column("node"),
                    batch.column("copies"),
                    pa.array([r.tobytes() for r in raw], pa.binary()),
                    pa.array([r.tobytes() for r in np.packbits(codes, axis=1)], pa.binary()),
                    pa.array([r.tobytes() for r in coder.factors(unit).astype(np.float32)], pa.binary()),
                ]
                yield pa.record_batch(
                    [pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), pa.array(coder.buckets(raw).ravel()), *(c.take(at) for c in stored)],
                    ["place", "bucket", "node", "copies", "vector", "code", "factors"],
                )

    dealt = distinct.mapInArrow(code, "place int, bucket long, node long, copies long, vector binary, code binary, factors binary")
    keys = distinct.mapInArrow(lambda b: (x.select(["place", "bucket"]) for x in code(b)), "place int, bucket long")
    large = keys.groupBy("place", "bucket").count().where(F.col("count") > BLOCK)
    large = large.select("place", "bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    cut = dealt.join(large, ["place", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    group = ["place", "bucket", "low", "high"]
    ready = tiles.select(*group, "part", "node", "copies", "vector", "code", "factors").repartition(*group).sortWithinPartitions(*group, "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for piece in (batch.slice(i, 8192) for i in range(0, batch.num_rows, 8192)):
                held.append(piece)
                last = [piece.column(c)[-1] for c in group]
                same = np.logical_and.reduce([piece.column(c).to_numpy() == v.as_py() for c, v in zip(group, last)])
                open_from = len(same) - int(same.sum())  # the last group may go on
                if open_from == 0:
                    continue
                held[-1] = piece.slice(0, open_from)
                yield _compared(coder, pa.Table.from_batches(held).combine_chunks().to_batches()[0], kind)
                held = [piece.slice(open_from)]
        if held:
            yield _compared(coder, pa.Table.from_batches(held).combine_chunks().to_batches()[0], kind)

    return ready.mapInArrow(compare, "node long, links long, tied long")


def op2(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id
"""

QUERIES = {"op2_near_vectors": (op2, SQL)}
