"""Repeated passages by a sparse suffix array.

A byte goes when a string of ``length`` bytes that covers it also starts earlier.  Sorting every
suffix of a corpus moves a hundred times its size, so suffixes are first thinned out by content:
of the ``length - GRAM + 1`` grams of GRAM bytes inside a string, the one with the smallest hash
is its anchor.  Equal strings have equal anchors at equal places, so only strings under one
anchor text need comparing, and neighbouring strings share their anchor: there is one anchor
for some thirty bytes.

Round one decides by hashes.  The span of an anchor is what its strings cover.  Anchors with the
same span are equal in all their strings, so all but the first are covered; this is done in
every batch before anything is dealt out, which takes the heat out of frequent passages.  Anchors
are range-partitioned by their leading bytes with splitters from a sample; leading bytes that
alone would overfill a task are dealt string by string instead.

Round two reads the texts again, for anchors that occur with different spans.  Their suffixes
(the strings below an anchor) go to the bucket of their leading bytes and are put in order there
by multikey quicksort, eight bytes a key; in a run of equal strings all but the first are covered.
Equal leading bytes never leave their bucket, so a bucket needs nothing of its neighbours: what
a boundary would cut in two is not cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.jaccard_join import grouped, mixed, slices
from riskframe.llm.shared import materialize, table, task_count

GRAM = 32
SLAB = 1 << 20  # bytes worked on at once
BROADCAST_ROWS = 1_000_000  # spans and documents with any that may be sent to every executor
_letters = np.random.default_rng(3).integers(1 << 62, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0xD6E8FEB86659FD93)
UNBASE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
LOW = np.uint64((1 << 31) - 1)
ANCHOR, STRING, COVER = 0, 1, 2


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width``, by doubling."""
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    rest = width - n
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not len(_powers) or len(_powers["up"]) < n:
        _powers["up"] = np.cumprod(np.r_[np.uint64(1), np.full(n, BASE)])
        _powers["down"] = np.cumprod(np.r_[np.uint64(1), np.full(n, UNBASE)])
    return _powers["up"][:n], _powers["down"][:n]


class Anchors:
    """Anchors of one or more texts in a buffer: place of the anchor, and the first and last
    start of the strings that it is the anchor of, as places in the buffer."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int):
        up, self.down = powers(len(raw) + 1)
        self.sums = np.r_[np.uint64(0), np.cumsum(_letters[raw] * up[: len(raw)])]
        self.raw, self.length = raw, length
        self.at = self.first = self.last = np.zeros(0, np.int64)
        self.text = np.zeros(0, np.int64)
        if len(raw) < length:
            return
        grams = self.hash(np.arange(len(raw) - GRAM + 1), GRAM)
        order = (grams & ~LOW) | np.arange(len(grams), dtype=np.uint64)
        own = (sliding_least(order, length - GRAM + 1) & LOW).astype(np.int64)
        text = np.searchsorted(starts, np.arange(len(own)), side="right") - 1
        inside = np.arange(len(own)) + length <= (starts + sizes)[text]
        cut = np.r_[True, (own[1:] != own[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])]
        first = np.flatnonzero(cut)
        last = np.r_[first[1:], len(own)] - 1
        kept = inside[first]
        self.first, self.last = first[kept], last[kept]
        self.at, self.text = own[self.first], text[self.first]
        self.gram = grams[self.at]

    def hash(self, at: np.ndarray, width) -> np.ndarray:
        return mixed((self.sums[at + width] - self.sums[at]) * self.down[at])

    def spans(self) -> np.ndarray:
        """Hash of all bytes that an anchor's strings cover, and of where the anchor lies in them."""
        shape = ((self.at - self.first) * 4096 + (self.last - self.first)).astype(np.uint64)
        return mixed(self.hash(self.first, self.last - self.first + self.length) + shape * BASE)

    def lead(self) -> np.ndarray:
        """Sort key of a suffix: its first six bytes, then 16 bits that keep one anchor text together."""
        key = np.zeros(len(self.at), np.uint64)
        for k in range(6):
            key = (key << np.uint64(8)) | self.raw[self.at + k]
        return (key << np.uint64(16)) | (self.gram >> np.uint64(48))


def buffers(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, Anchors]]:
    """Anchors of texts, some megabytes at once: (numbers of the texts, anchors, starts)."""
    held, size = [], 0
    for i, t in enumerate(texts):
        if len(t) >= length:
            held.append(i)
            size += len(t)
        if held and (size >= SLAB or i == len(texts) - 1):
            sizes = np.array([len(texts[k]) for k in held])
            starts = np.cumsum(sizes) - sizes
            raw = np.frombuffer(b"".join(texts[k] for k in held), np.uint8)
            yield np.array(held), starts, Anchors(raw, starts, sizes, length)
            held, size = [], 0


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals: sorted, and joined where they overlap or touch."""
    order = np.lexsort((end, begin))
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.r_[True, begin[1:] > end[:-1]] if len(begin) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return begin[first], end[np.r_[first[1:], len(begin)] - 1] if len(first) else end


def merged_by(owner: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of the intervals of every owner."""
    out = []
    order = np.argsort(owner, kind="stable")
    owner, begin, end = owner[order], begin[order], end[order]
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else []
    for a, b in zip(cuts, [*cuts[1:], len(owner)]):
        x, y = merged(begin[a:b], end[a:b])
        out.append((np.full(len(x), owner[a]), x, y))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(p) for p in zip(*out)) if out else (none, none, none)


def first_of_runs(keys: list[np.ndarray], doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by ``keys``, then document and place, and which of them begin a run of equal keys."""
    order = np.lexsort((place, doc, *reversed(keys)))
    new = np.r_[True, np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])] if len(order) else np.zeros(0, bool)
    return order, new


def multikey_runs(texts: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of equally long strings (rows of bytes), eight bytes a key.

    Every pass orders only the rows still tied with a neighbour, by their next key.  Returns the
    order, and the runs of equal strings in it, each by document and place."""
    pad = -texts.shape[1] % 8
    words = np.pad(texts, ((0, 0), (0, pad))).view(">u8").astype(np.uint64)
    order = np.lexsort((place, doc))
    run = np.zeros(len(order), np.int64)  # number of the run at every place of the order
    tied = np.arange(len(order))
    for k in range(words.shape[1]):
        if not len(tied):
            break
        value = words[order[tied], k]
        turn = np.lexsort((value, run[tied]))  # stable: document and place stay in order
        order[tied] = order[tied][turn]
        value, group = value[turn], run[tied]
        new = np.r_[True, (value[1:] != value[:-1]) | (group[1:] != group[:-1])]
        # places of a run are neighbours, so a new number per first place keeps runs apart
        run[tied] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
        alone = new & np.r_[new[1:], True]
        tied = tied[~alone]
    return order, np.r_[True, run[1:] != run[:-1]] if len(run) else np.zeros(0, bool)


# a and b: hashes; place: first byte; shape: see WIDE
ROW = pa.schema([("task", pa.int32()), ("kind", pa.int8()), ("a", pa.int64()), ("b", pa.int64()), ("doc", pa.int64()), ("place", pa.int64()), ("shape", pa.int64())])
ROW_SQL = "task int, kind byte, a long, b long, doc long, place long, shape long"
WIDE = 1 << 40  # shape: distance of the anchor times WIDE, plus size


def _rows(kind: int, task, a, b, doc, begin, end, anchor=None) -> pa.RecordBatch:
    """Rows in the order of documents, which the shuffle's compression likes."""
    order = np.lexsort((begin, doc))
    fill = lambda v: (np.full(len(doc), v) if np.isscalar(v) else v)[order]
    signed = lambda v: v.view(np.int64) if v.dtype == np.uint64 else v.astype(np.int64)
    shape = end - begin if anchor is None else end - begin + (anchor - begin) * WIDE
    columns = [fill(task).astype(np.int32), np.full(len(doc), kind, np.int8), *(signed(fill(v)) for v in (a, b, doc, begin, shape))]
    return pa.record_batch([pa.array(v) for v in columns], schema=ROW)


def splitters(rows: DataFrame, length: int, tasks: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled splitters between ``tasks`` buckets of leading bytes, and the leading bytes that
    alone hold more than half a bucket's share of the sampled documents' anchors."""
    count = rows.count()
    spread = F.xxhash64("doc", F.lit("splitters"))
    part = min(1.0, sample / max(1, count))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            for _, _, found in buffers(texts, length):
                lead = np.random.default_rng(len(texts)).permutation(found.lead())[: 64 * len(texts)]
                yield pa.record_batch([pa.array(lead.view(np.int64))], ["lead"])

    near = rows.where(F.pmod(spread, F.lit(1 << 24)) <= int(part * (1 << 24)))
    lead = np.sort(near.mapInArrow(run, "lead long").toArrow().column("lead").to_numpy().view(np.uint64))
    if not len(lead):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    cuts = lead[(np.arange(1, tasks) * len(lead)) // tasks]
    value, seen = np.unique(lead, return_counts=True)
    return cuts, value[(seen > len(lead) / tasks / 2) & (seen > 32)]


def repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100, sample: int = 2_000) -> DataFrame:
    """Bytes of every text that a string of ``length`` bytes covers which also starts earlier: in
    a document with a smaller key, or earlier in the same one.

    Returns key and spans (array of (begin, end) in bytes, sorted, apart), one row per key that
    loses any.  Strings are judged on the input and never cross documents.  Null texts and texts
    shorter than ``length`` lose nothing, and rows with a null key neither lose nor take bytes.
    Keys are expected to be distinct; rows that share a key share their spans.  An empty table
    gives an empty result.  ``sample`` bounds the documents that splitters are taken from.
    """
    rows = docs.where(F.col(key).isNotNull() & (F.octet_length(F.col(text)) >= length)).select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    tasks = task_count(rows, F.octet_length("text"), 32 << 20)
    cuts, heavy = splitters(rows, length, tasks, sample)
    cuts, heavy = (docs.sparkSession.sparkContext.broadcast(v) for v in (cuts, heavy))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, names = [t.encode() for t in batch.column("text").to_pylist()], batch.column("doc").to_numpy()
            for numbers, starts, found in buffers(texts, length):
                doc, base = names[numbers[found.text]], starts[found.text]
                span, lead = found.spans(), found.lead()
                # equal spans of a batch: all but the first are covered, whatever else there is
                order, new = first_of_runs([found.gram, span], doc, found.at - base)
                again, once = order[~new], order[new]
                owner, begin, end = merged_by(doc[again], (found.first - base)[again], (found.last - base)[again] + length)
                yield _rows(COVER, owner % tasks, 0, 0, owner, begin, end)
                hot = np.isin(lead[once], heavy.value)
                own = once[~hot]
                bucket = np.searchsorted(cuts.value, lead[own], side="right")
                yield _rows(ANCHOR, bucket, found.gram[own] >> np.uint64(16), span[own], doc[own], (found.first - base)[own], (found.last - base)[own] + length, (found.at - base)[own])
                own = once[hot]
                count = found.last[own] - found.first[own] + 1
                at = np.repeat(found.first[own], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                if len(at):
                    one, two = found.hash(at, length), found.hash(at + 1, length - 1)
                    who, where = np.repeat(doc[own], count), at - np.repeat(base[own], count)
                    order, new = first_of_runs([one, two], who, where)
                    again, first = order[~new], order[new]
                    owner, begin, end = merged_by(who[again], where[again], where[again] + length)
                    yield _rows(COVER, owner % tasks, 0, 0, owner, begin, end)
                    yield _rows(STRING, (one[first] % np.uint64(tasks)).astype(np.int64), one[first], two[first], who[first], where[first], where[first] + length)

    def by_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches), ROW)
        kind, a, b, doc, begin, shape = (whole.column(c).to_numpy() for c in ROW.names[1:])
        end, anchor = begin + shape % WIDE, begin + shape // WIDE
        covered = [np.flatnonzero(kind == COVER)]
        for own in (np.flatnonzero(kind == ANCHOR), np.flatnonzero(kind == STRING)):
            order, new = first_of_runs([a[own], b[own]], doc[own], anchor[own])
            covered.append(own[order[~new]])
            if len(own) and kind[own[0]] == ANCHOR:
                first = own[order[new]]
                several = np.r_[False, a[first][1:] == a[first][:-1]]
                several |= np.r_[several[1:], False]
                asked = first[several]
                yield _rows(ANCHOR, 0, a[asked], 0, doc[asked], begin[asked], end[asked], anchor[asked])
        covered = np.concatenate(covered)
        owner, x, y = merged_by(doc[covered], begin[covered], end[covered])
        yield _rows(COVER, 0, 0, 0, owner, x, y)

    dealt = rows.mapInArrow(anchors, ROW_SQL).repartitionById(tasks, F.col("task"))
    first = materialize(dealt.mapInArrow(by_hash, ROW_SQL), "suffix-hashes")

    asked = first.where(F.col("kind") == ANCHOR).groupBy("doc").agg(F.collect_list(F.struct("a", "place", "shape")).alias("asked"))
    part = "gram long, lead long, doc long, begin int, bytes binary"

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            texts, lists = batch.column("text").to_pylist(), batch.column("asked")
            sizes = lists.value_lengths().to_numpy()
            values = lists.flatten()
            gram, begin, shape = (values.field(i).to_numpy() for i in range(3))
            end, place = begin + shape % WIDE, begin + shape // WIDE
            row = np.repeat(np.arange(len(texts)), sizes)
            raw = [t.encode() for t in texts]
            data = [raw[r][x:y] for r, x, y in zip(row, begin, end)]
            lead = np.array([int.from_bytes(raw[r][p : p + 6], "big") for r, p in zip(row, place)], np.uint64) << np.uint64(16)
            lead |= gram.view(np.uint64) >> np.uint64(32)  # grams have 48 bits here
            yield pa.record_batch(
                [pa.array(gram), pa.array(lead.view(np.int64)), batch.column("doc").take(pa.array(row)), pa.array(begin.astype(np.int32)), pa.array(data, pa.binary())],
                ["gram", "lead", "doc", "begin", "bytes"],
            )

    dealt = rows.join(asked, "doc").select("doc", "text", "asked").mapInArrow(suffixes, part)

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = batch.column("lead").to_numpy().view(np.uint64)
            yield batch.append_column("task", pa.array(np.searchsorted(cuts.value, lead, side="right").astype(np.int32)))

    dealt = dealt.mapInArrow(bucket, f"{part}, task int").repartitionById(tasks, F.col("task")).sortWithinPartitions("lead", "gram")

    def by_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in grouped(batches, ["lead", "gram"]):  # anchors of one text belong together
            held.append(group)
            size += group.num_rows
            if size >= 2000:
                yield _sorted_cover(pa.concat_tables(held), length)
                held, size = [], 0
        if held:
            yield _sorted_cover(pa.concat_tables(held), length)

    second = dealt.mapInArrow(by_bytes, "doc long, begin long, end long")
    covers = first.where(F.col("kind") == COVER).select("doc", F.col("place").alias("begin"), (F.col("place") + F.col("shape")).alias("end")).unionByName(second)
    lists = covers.groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            found = batch.column("spans")
            sizes, values = found.value_lengths().to_numpy(), found.flatten()
            row = np.repeat(np.arange(len(sizes)), sizes)
            owner, begin, end = merged_by(row, values.field(0).to_numpy(), values.field(1).to_numpy())
            counts = np.bincount(owner, minlength=len(sizes))
            spans = pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], fields=list(item))
            yield pa.record_batch([batch.column("doc"), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), spans)], ["doc", "spans"])

    return lists.mapInArrow(joined, "doc long, spans array<struct<begin long, end long>>").withColumnRenamed("doc", key)


def _sorted_cover(rows: pa.Table, length: int) -> pa.RecordBatch:
    """Covered bytes of some anchors: all strings below them in order, all but the first of equals."""
    data = rows.column("bytes").to_pylist()
    doc, begin = rows.column("doc").to_numpy(), rows.column("begin").to_numpy().astype(np.int64)
    count = np.array([len(d) - length + 1 for d in data])
    raw = np.frombuffer(b"".join(data), np.uint8)
    offset = np.cumsum([0, *map(len, data)])[:-1]
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    row = np.repeat(np.arange(len(data)), count)
    found = []
    # anchors of one text come together, so parts of a few thousand strings keep them whole
    edges = np.flatnonzero(np.r_[True, rows.column("gram").to_numpy()[1:] != rows.column("gram").to_numpy()[:-1], True])
    string_at = np.r_[0, np.cumsum(count)]
    at = 0
    while at < len(edges) - 1:
        to = at + 1
        while to < len(edges) - 1 and string_at[edges[to + 1]] - string_at[edges[at]] <= 20_000:
            to += 1
        own = slice(string_at[edges[at]], string_at[edges[to]])
        view = np.lib.stride_tricks.sliding_window_view(raw, length)[offset[row[own]] + within[own]]
        who, where = doc[row[own]], begin[row[own]] + within[own]
        order, new = multikey_runs(view, who, where)
        again = order[~new]
        found.append(merged_by(who[again], where[again], where[again] + length))
        at = to
    owner, x, y = (np.concatenate(p) for p in zip(*found))
    return pa.record_batch([pa.array(owner), pa.array(x), pa.array(y)], ["doc", "begin", "end"])


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100, sample: int = 2_000) -> DataFrame:
    """Key, spans removed, n_bytes and the remaining bytes (kept) of every row; see repeated_bytes."""
    found = materialize(repeated_bytes(docs, key, text, length, sample).select(F.col(key).alias("k"), "spans"), "suffix-spans")
    if (found.agg(F.sum(F.size("spans") + 1).alias("n")).first()["n"] or 0) <= BROADCAST_ROWS:
        found = F.broadcast(found)  # by count; both sides are shuffled otherwise
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(found, F.col("key") == F.col("k"), "left").select("key", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            kept, sizes = [], []
            for t, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = t.encode()
                sizes.append(len(raw))
                inside = [(s["begin"], min(s["end"], len(raw))) for s in spans or ()]
                kept.append(b"".join(raw[a:b] for (_, a), (b, _) in zip([(0, 0), *inside], [*inside, (len(raw), 0)])) if inside else raw)
            yield pa.record_batch([batch.column("key"), batch.column("spans"), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary())], ["key", "spans", "n_bytes", "kept"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, spans array<struct<begin long, end long>>, n_bytes long, kept binary").withColumnRenamed("key", key)


def op3(spark, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {"op3_suffix_dedup": (op3, None)}
