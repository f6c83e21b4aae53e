"""Token counts from a compiled finite-state tokenizer.

A byte-pair tokenizer is turned into a deterministic transducer over characters whose
transitions carry the change of the token count.  Two machines make it up:

* pieces: the split into words, numbers, symbols and white space.  A decision that hangs on the
  next character (the last blank of a run, an English contraction) is taken provisionally and
  the transition that decides it carries the correction, so counts of prefixes are always exact.
* merges: inside a piece.  A sequence of tokens is the tokenizer's own answer exactly when each
  token alone and each neighbouring pair is.  So the last token after each byte follows from the
  last tokens at the earlier bytes, and a state needs only the places where a token still to
  come may start: the suffixes that begin a longer token, with the last token before each.

States and transitions are compiled when first met and kept; a full table is dropped and
compiled anew, which changes no count.

Long texts are cut into chunks.  A chunk does not know the state it starts in, but every state
leads to the same one at the first blank after a non-blank.  Its state map is therefore
(head, count, tail): text before that place, tokens between the first and the last such place,
and text after it.  Maps compose associatively, so the maps of a text are put together pairwise
in a logarithmic number of levels, and only heads and tails are read again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import kept, table

START, BLANK, LETTER, NUMBER, SYMBOL, QUOTE, HELD = range(7)
# Fixed values of the tokenizer's published split pattern: English contractions after a quote mark.
CLOSED = "stmd"
PAIRED = {"r": "e", "v": "e", "l": "l"}

LETTERS, NUMBERS, BLANKS = regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(r"\s")
SURE_CUT = regex.compile(r"\S[ \n]")


def character_class(c: str) -> int:
    if BLANKS.match(c):
        return BLANK
    return LETTER if LETTERS.match(c) else NUMBER if NUMBERS.match(c) else SYMBOL


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that print stand for
    themselves, the others take the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeMachine:
    """Last tokens of all prefixes of a piece, by bytes."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        self.halves = {bytes([b]): None for b in range(256)}
        self.age = {bytes([b]): -1 for b in range(256)}
        for i, (a, b) in enumerate(merges):
            if a + b not in self.age:
                self.age[a + b], self.halves[a + b] = i, (a, b)
        self.rank = {pair: i for i, pair in enumerate(merges)}
        # a token that the merges do not make of its own bytes never comes out
        whole = lambda t: self.halves[t] is None or self._fits(*self.halves[t], self.age[t])
        self.tokens = {t for t in self.age if whole(t)}
        self.begins = {t[:n] for t in self.tokens for n in range(len(t))}
        self.first = ((b"", None, 0),)
        self.fits = lru_cache(maxsize=1 << 18)(self._fits)

    def _fits(self, left: bytes, right: bytes, before: int | None = None) -> bool:
        """Whether the merges leave ``left`` and ``right`` side by side.

        Their last merges are taken back one by one, latest first.  If at some time the pieces
        that then meet at the border had a merge of their own that came earlier than all taken
        back on both sides, the tokenizer would have crossed the border.  ``before``: merges
        from this one on do not count.
        """
        open_from = len(self.rank) if before is None else before
        while True:
            across = self.rank.get((left, right))
            # of two merges of the same rank the left one is made first
            if across is not None and across < open_from:
                return False
            undo_left = self.age[left] > self.age[right]
            if self.halves[left if undo_left else right] is None:
                return True  # the later of the two is a byte, so both are
            if undo_left:
                open_from, left = self.age[left], self.halves[left][1]
            else:
                open_from, right = self.age[right] + 1, self.halves[right][0]

    def _step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """State: for each place where a coming token may start, longest first, the bytes since
        then, the last token before it (None at the start), and the count there less the count
        at the end."""
        grown = [(begun + bytes([byte]), last, count) for begun, last, count in state]
        for token, last, count in grown:
            if token in self.tokens and (last is None or self.fits(last, token)):
                change = count + 1
                break
        else:
            raise ValueError("the merges do not form a tokenizer")
        kept = tuple((begun, last, count - change) for begun, last, count in grown if begun in self.begins)
        return (*kept, (b"", token, 0)), change

    def read(self, state: tuple, text: str) -> tuple[tuple, int]:
        total = 0
        for byte in text.encode():
            state, change = self._step(state, byte)
            total += change
        return state, total


class Transducer:
    """Characters in, changes of the token count out.  ``specials`` are strings the library
    takes out as one token each before anything else."""

    def __init__(self, merges: list[tuple[bytes, bytes]], specials: list[str], limit: int = 200_000):
        self.merges = MergeMachine(merges)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.limit = limit
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, dict] = {}
        self.opened: dict[str, tuple[dict, int]] = {}  # by the character that begins a piece
        self.start = self.state((START,))

    def state(self, key: tuple) -> dict:
        """The transitions known of a state, by character; its key is under None."""
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = {None: key}
        return found

    def _open(self, c: str, before: str = "") -> tuple[tuple, int]:
        inner, change = self.merges.read(self.merges.first, before + c)
        kind = character_class(c)
        return (QUOTE if c == "'" and not before else kind, inner), change

    def _contraction(self, tail: str, before: str) -> tuple[tuple, int]:
        count = lambda s: self.merges.read(self.merges.first, s)[1]
        return (START,), count("'" + before + tail) - count("'") - (count(before) if before else 0)

    def _next(self, key: tuple, c: str) -> tuple[tuple, int]:
        mode, kind = key[0], character_class(c)
        if mode == BLANK:
            _, inner, change, last, single = key
            if kind == BLANK:
                inner, change = self.merges.read(inner, c)
                return (BLANK, inner, change, c, False), change
            if last == " ":
                to, more = self._open(c, " ")
                return to, more - change
            to, more = self._open(c)
            alone = 0 if single else self.merges.read(self.merges.first, last)[1] - change
            return to, more + alone
        if kind == BLANK:
            inner, change = self.merges.read(self.merges.first, c)
            return (BLANK, inner, change, c, True), change
        if mode == QUOTE:
            if c in CLOSED:
                return self._contraction(c, "")
            if c in PAIRED:
                (_, inner), change = self._open(c)
                return (HELD, inner, c), change
            mode = SYMBOL
        elif mode == HELD:
            if c == PAIRED[key[2]]:
                return self._contraction(c, key[2])
            mode = LETTER
        if mode == kind:
            inner, change = self.merges.read(key[1], c)
            return (mode, inner), change
        return self._open(c)

    def _compile(self, state: dict, c: str) -> tuple[dict, int]:
        key = state[None]
        if key[0] in (START, LETTER, NUMBER, SYMBOL):
            found = self.opened.get(c)
            if found is None:
                to, change = self._next((START,), c)
                found = self.opened[c] = (self.state(to), change, character_class(c))
            if found[2] != key[0]:  # a new piece, whatever came before
                return found
        to, change = self._next(key, c)
        found = state[c] = (self.state(to), change)
        return found

    def _plain(self, text: str) -> int:
        if len(self.states) > self.limit:
            self.reset()
        state, total = self.start, 0
        for c in text:
            found = state.get(c)
            if found is None:
                found = self._compile(state, c)
            state = found[0]
            total += found[1]
        return total

    def count(self, text: str) -> int:
        if self.specials is None:
            return self._plain(text)
        parts = self.specials.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    # ---- chunks ----

    def cut(self, text: str, size: int) -> list[str]:
        """Chunks of about ``size`` characters; no cut inside a special string."""
        taboo = [m.span() for m in self.specials.finditer(text)] if self.specials else []
        at, cuts = 0, [0]
        for end in range(size, len(text), size):
            while at < len(taboo) and taboo[at][1] <= end:
                at += 1
            cuts.append(taboo[at][0] if at < len(taboo) and taboo[at][0] < end else end)
        cuts = [*dict.fromkeys(cuts), len(text)]
        return [text[a:b] for a, b in zip(cuts, cuts[1:])]

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(head, count, tail); count None when the chunk has no place that all states agree on."""
        first = SURE_CUT.search(chunk)
        if first is None:
            return chunk, None, ""
        begin = first.start() + 1
        last = begin
        for found in SURE_CUT.finditer(chunk, max(begin, len(chunk) - 512)):
            last = found.start() + 1
        return chunk[:begin], self.count(chunk[begin:last]), chunk[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        if a[1] is None and b[1] is None:
            return a[0] + b[0], None, ""
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.count(a[2] + b[0]) + b[1], b[2]

    def total(self, maps: list[tuple]) -> int:
        """Neighbours are composed level by level, as in a parallel scan."""
        while len(maps) > 1:
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])]
            maps = pairs + ([maps[-1]] if len(maps) % 2 else [])
        head, count, tail = maps[0]
        return self.count(head) + ((count or 0) + self.count(tail) if count is not None else 0)


def compiled(source: str) -> Transducer:
    model = json.loads(source)
    letters = byte_letters()
    turn = lambda s: bytes(letters[c] for c in s)
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    return Transducer([(turn(a), turn(b)) for a, b in pairs], [t["content"] for t in model["added_tokens"]])


def transducer(source: str) -> Transducer:
    """The transducer of a byte-level tokenizer file (its text), one per worker process, which
    goes on with the states that earlier tasks have compiled."""
    return kept("transducer", source, lambda: compiled(source))


def batches(run: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator], Iterator]:
    return lambda found: (run(b) for b in found)


def token_counts(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 1024, chunk: int = 1 << 16) -> DataFrame:
    """Tokens of every text as the library gives them, without added special tokens.

    ``tokenizer``: place of a byte-level tokenizer file, read once on the driver (its size is
    that of a vocabulary).  Returns key, n_bytes, n_tokens, over_limit, one row per input row.
    A null text counts as empty; null keys and repeated rows stay as they are; other columns
    are ignored; an empty table gives an empty result.

    Texts of at most ``chunk`` characters are counted where they are read.  Chunks of longer
    texts are dealt to all tasks, and their state maps (three short values) meet per text.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        source = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    kind = rows.schema["key"].dataType.simpleString()

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = transducer(source.value)
        counts = np.fromiter((machine.count(t) for t in batch.column("text").to_pylist()), np.int64, batch.num_rows)
        return pa.record_batch([batch.column("key"), batch.column("n_bytes"), pa.array(counts)], ["key", "n_bytes", "n_tokens"])

    short = rows.where(F.length("text") <= chunk).select("key", n_bytes, "text")
    short = short.mapInArrow(batches(whole), f"key {kind}, n_bytes long, n_tokens long")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = transducer(source.value)
        parts = [machine.cut(t, chunk) for t in batch.column("text").to_pylist()]
        at = pa.array(np.repeat(np.arange(batch.num_rows), [len(p) for p in parts]))
        kept = batch.select(["key", "n_bytes", "digest"]).take(at)
        return pa.record_batch(
            [
                *kept.columns,
                pa.array([i for p in parts for i in range(len(p))], pa.int32()),
                pa.array([len(p) for p in parts for _ in p], pa.int32()),
                pa.array([c for p in parts for c in p], pa.string()),
            ],
            ["key", "n_bytes", "digest", "place", "places", "chunk"],
        )

    def mapped(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = transducer(source.value)
        heads, counts, tails = zip(*map(machine.chunk_map, batch.column("chunk").to_pylist())) if batch.num_rows else ((), (), ())
        kept = batch.select(["key", "n_bytes", "digest", "place", "places"])
        return pa.record_batch([*kept.columns, pa.array(heads, pa.string()), pa.array(counts, pa.int64()), pa.array(tails, pa.string())], [*kept.schema.names, "head", "count", "tail"])

    def joined(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = transducer(source.value)
        totals = []
        for maps in batch.column("maps").to_pylist():
            own = {m["place"]: (m["head"], m["count"], m["tail"]) for m in maps}
            totals.append(machine.total([own[i] for i in sorted(own)]))
        return pa.record_batch([batch.column("key"), batch.column("n_bytes"), pa.array(totals, pa.int64())], ["key", "n_bytes", "n_tokens"])

    head = f"key {kind}, n_bytes long, digest string, place int, places int"
    chunks = (
        rows.where(F.length("text") > chunk)
        .select("key", n_bytes, F.sha2("text", 256).alias("digest"), "text")
        .mapInArrow(batches(cut), f"{head}, chunk string")
        .repartition("digest", "place")
    )
    maps = chunks.mapInArrow(batches(mapped), f"{head}, head string, count long, tail string")
    # rows with the same key and text meet; each of them has every chunk once
    long = (
        maps.groupBy("key", "n_bytes", "digest")
        .agg(F.collect_set(F.struct("place", "head", "count", "tail")).alias("maps"), (F.count("*") / F.max("places")).cast("int").alias("copies"))
        .select("key", "n_bytes", "maps", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"))
        .select("key", "n_bytes", "maps")
        .mapInArrow(batches(joined), f"key {kind}, n_bytes long, n_tokens long")
    )
    return short.unionByName(long).select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op7(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op7_token_counts": (op7, None)}
