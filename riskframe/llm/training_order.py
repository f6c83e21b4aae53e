"""Token ids in training order: fixed-stride shards that are read one after the other.

Texts become token ids and are cut into sequences.  Every sequence has an index without gaps;
a keyed Feistel permutation of the index range gives its slot in the training order, so any
worker can compute where a sequence goes, or came from, without a shuffle buffer or a sort key.  Slots are dealt out by range; a shard holds equally many records of equal length, so
slot s lies in shard s // per_shard at byte (s % per_shard) * stride, and a run that stopped
resumes at its slot.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskframe.llm.shared import kept, materialize, table
from riskframe.sources.scratch import scratch_path


class Feistel:
    """A keyed permutation of range(n): four Feistel rounds over the next even number of bits,
    walking the cycle until a value falls inside the range (under four steps on average)."""

    def __init__(self, n: int, key: int, rounds: int = 4):
        self.n = max(1, n)
        self.half = max(1, -(-(self.n - 1).bit_length() // 2))
        keys = np.random.SeedSequence(key).generate_state(rounds, np.uint64)
        self.keys = [np.uint64(k) for k in keys]
        self.mask, self.bits = np.uint64((1 << self.half) - 1), np.uint64(self.half)

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.bits, x & self.mask
        if back:
            for k in reversed(self.keys):
                left, right = right ^ self._round(left, k), left
        else:
            for k in self.keys:
                left, right = right, left ^ self._round(right, k)
        return (left << self.bits) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(np.asarray(x, np.uint64), back)
        while (out := x >= np.uint64(self.n)).any():
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def slots(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, False)

    def indexes(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, True)


def tokenizer(ranks: dict[bytes, int], pattern: str):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoder(source: str, pattern: str):
    """The encoder of a rank file (its text), one per worker process."""
    ranks = lambda: {base64.b64decode(a): int(b) for a, b in map(str.split, source.splitlines())}
    return kept("encoder", (source, pattern), lambda: tokenizer(ranks(), pattern))


def encoded(docs: DataFrame, ranks: str, pattern: str, length: int, key: str, text: str) -> DataFrame:
    """key, tokens (little-endian two-byte ids), n (sequences), block (the task that made the
    row) and before (sequences of earlier rows of that task)."""
    with open(ranks, encoding="ascii") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, block, before = encoder(source.value, pattern), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [np.array(coder.encode_ordinary(t), "<u2") for t in batch.column("text").to_pylist()]
            n = np.array([len(i) // length + 1 for i in ids], np.int64)  # room for the end id
            begin = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.record_batch(
                [batch.column("key"), pa.array([i.tobytes() for i in ids], pa.binary()), pa.array(n), pa.array(np.full(len(n), block)), pa.array(begin)],
                ["key", "tokens", "n", "block", "before"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, tokens binary, n long, block long, before long")


def training_order(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    end_id: int,
    seed: int = 9,
    length: int = 1024,
    per_shard: int = 2048,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Token sequences with their slots.

    Returns key, part (number of the sequence within its text), n_tokens, slot, shard,
    byte_offset, ids (binary, two bytes an id, ``length`` ids, the end id after the text and as
    padding).  Every text ends with ``end_id``; so an empty or null text is one sequence, and an
    empty table gives an empty result.  Repeated rows are separate sequences, null keys are
    kept, other columns are ignored.  The index follows the order in which the input is read, so
    the same files read in the same splits give the same order again.
    """
    spark = docs.sparkSession
    # the written table fixes the index: a task that runs again is committed once
    tokens = materialize(encoded(docs, ranks, pattern, length, key, text), "order-tokens")
    blocks = tokens.groupBy("block").agg(F.sum("n").alias("n"))
    total = blocks.agg(F.sum("n").alias("n")).first()["n"] or 0
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    # one row per input task, so bounded by the number of input partitions
    rows = tokens.join(F.broadcast(offsets), "block").select("key", "tokens", (F.col("offset") + F.col("before")).alias("first"))
    permutation = Feistel(total, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b, "<u2") for b in batch.column("tokens").to_pylist()]
            parts = np.array([len(i) // length + 1 for i in ids], np.int64)
            row = np.repeat(np.arange(len(ids)), parts)
            part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            slot = permutation.slots(batch.column("first").to_numpy()[row] + part) if len(row) else part
            pieces = [ids[r][p * length : (p + 1) * length] for r, p in zip(row, part)]
            yield pa.record_batch(
                [batch.column("key").take(pa.array(row)), pa.array(part), pa.array(slot), pa.array([p.tobytes() for p in pieces], pa.binary())],
                ["key", "part", "slot", "own"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    shards = max(1, -(-int(total) // per_shard))
    cut = rows.mapInArrow(run, f"key {kind}, part long, slot long, own binary")
    # slots are a permutation: equal ranges hold equally many, no sampling is needed
    tasks = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shards // 8)))
    # whole shards, so that each is written by one task
    ranges = cut.repartitionById(tasks, F.expr(f"cast((slot div {per_shard}) * {tasks} div {shards} as int)"))
    fill = F.unhex(F.lit(int(end_id).to_bytes(2, "little").hex() * length))
    own = F.octet_length("own")
    return ranges.sortWithinPartitions("slot").select(
        F.col("key").alias(key),
        "part",
        F.least(F.lit(length), F.expr(f"octet_length(own) div 2 + if(octet_length(own) < {2 * length}, 1, 0)")).cast("long").alias("n_tokens"),
        "slot",
        F.floor(F.col("slot") / per_shard).cast("long").alias("shard"),
        (F.col("slot") % per_shard * (2 * length)).alias("byte_offset"),
        F.concat("own", F.substring(fill, 1, 2 * length - own)).alias("ids"),
    )


def write_shards(sequences: DataFrame, path: str) -> None:
    """One file per range of shards; a row holds a whole shard as fixed-stride bytes, and beside
    them where its sequences come from: keys (of the first column), parts and n_tokens.

    The records of a shard come from one task, in order, so they are put together without a
    shuffle; the file of a lost task is written again with the same bytes.
    """
    key = sequences.columns[0]
    rows = sequences.select("shard", "slot", "ids", F.col(key).alias("key"), "part", "n_tokens")
    kind = to_arrow_type(rows.schema["key"].dataType)
    names = ["shard", "first_slot", "n_sequences", "data", "keys", "parts", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def shard() -> pa.RecordBatch:
            slots, ids, keys, parts, n_tokens = zip(*held)
            whole = pa.array([b"".join(ids)], pa.binary())
            origin = [pa.array([list(keys)], pa.list_(kind)), *(pa.array([list(c)], pa.list_(pa.int64())) for c in (parts, n_tokens))]
            return pa.record_batch([pa.array([at]), pa.array([slots[0]]), pa.array([len(ids)]), whole, *origin], names)

        for batch in batches:
            for s, *row in zip(*(batch.column(c).to_pylist() for c in ("shard", "slot", "ids", "key", "part", "n_tokens"))):
                if s != at and held:
                    yield shard()
                    held = []
                at = s
                held.append(row)
        if held:
            yield shard()

    rows.mapInArrow(run, SHARDS.format(kind=rows.schema["key"].dataType.simpleString())).write.option("compression", "zstd").parquet(path)


SHARDS = "shard long, first_slot long, n_sequences long, data binary, keys array<{kind}>, parts array<long>, n_tokens array<long>"


def from_shards(spark: SparkSession, path: str, key: str, kind: str, length: int, per_shard: int) -> DataFrame:
    """The sequences of written shards, as ``training_order`` gives them.

    The shards must be 0, 1, 2 and so on, each once, begin at their slot and all but the last be
    full; a shard whose bytes are not a stride per sequence stops the read.  ``slot`` is the order.
    """
    shards = spark.read.schema(SHARDS.format(kind=kind)).parquet(path)
    n, last = F.count("*"), F.max("shard")
    begins, full = F.col("first_slot") == F.col("shard") * per_shard, F.col("n_sequences") == per_shard
    told = shards.agg(
        n.alias("n"), F.countDistinct("shard").alias("distinct"), last.alias("last"), F.count_if(~begins).alias("moved"), F.count_if(~full).alias("short"), F.max(F.when(~full, F.col("shard"))).alias("at")
    ).first()
    if told["n"] and (told["n"] != told["distinct"] or told["n"] != told["last"] + 1 or told["moved"] or told["short"] > 1 or told["at"] not in (None, told["last"])):
        raise RuntimeError(f"shards of {path} are not whole: {told.asDict()}")
    stride = 2 * length
    wrong = (F.octet_length("data") != F.col("n_sequences") * stride) | (F.size("keys") != F.col("n_sequences"))
    data = F.when(wrong, F.raise_error(F.concat(F.lit("bytes of shard "), F.col("shard").cast("string")))).otherwise(F.col("data"))
    origin = F.posexplode(F.arrays_zip("keys", "parts", "n_tokens")).alias("at", "of")
    rows = shards.withColumn("data", data).select("shard", "first_slot", "data", origin)
    return rows.select(
        F.col("of.keys").alias(key),
        F.col("of.parts").alias("part"),
        F.col("of.n_tokens").alias("n_tokens"),
        (F.col("first_slot") + F.col("at")).alias("slot"),
        "shard",
        (F.col("at") * stride).cast("long").alias("byte_offset"),
        F.expr(f"substring(data, at * {stride} + 1, {stride})").alias("ids"),
    )


def read_from(spark: SparkSession, path: str, slot: int, length: int, per_shard: int) -> DataFrame:
    """The sequences from ``slot`` on, as a run that resumes there reads them: slot, ids."""
    shards = spark.read.parquet(path).where(F.col("shard") >= slot // per_shard)
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_sequences") - 1)).alias("at")
    rows = shards.select("first_slot", "data", at)
    ids = F.expr(f"substring(data, cast(at * {2 * length} + 1 as int), {2 * length})")
    return rows.select((F.col("first_slot") + F.col("at")).alias("slot"), ids.alias("ids")).where(F.col("slot") >= slot)


def written_order(docs: DataFrame, ranks: str, pattern: str, end_id: int, length: int = 1024, per_shard: int = 2048, key: str = "doc_id", **how) -> DataFrame:
    """``training_order`` written as shards to the shared folder; the rows are those read back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    sequences = training_order(docs, ranks, pattern, end_id, length=length, per_shard=per_shard, key=key, **how)
    write_shards(sequences, path)
    return from_shards(spark, path, key, sequences.schema[key].dataType.simpleString(), length, per_shard)


def op9(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents") if docs is None else docs
    return written_order(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, end_id=50256)


QUERIES = {"op9_training_order": (op9, None)}
