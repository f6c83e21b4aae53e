"""Secrets in texts: fixed patterns, and strings that a primed compressor finds new.

A candidate is a long run of key characters with a letter in it, near a word that speaks of
secrets.  Its novelty is what it adds to the compressed size of the code around it, with a
dictionary at hand: usual identifiers, and the pieces of words that most documents of the table
hold.  Words, identifiers, paths and repeated values add little, a random string adds about its
own length.  Candidates that hardly compress are reported beside the pattern matches.  Every
text is read whole, twice: pieces are counted in the tasks and only their counts are shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import table

# The kinds of pattern matches, in the order of their listing.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# a failing match of these two hides no other: runs are maximal and only get shorter
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

# Words and identifiers are made of pieces only; random strings of mixed case or with digits are not.
RUN = re.compile(r"(?<![A-Za-z0-9])(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+)++(?![A-Za-z0-9])")
# Pieces are shorter than any candidate, so that no copied secret is in the dictionary as a whole.
PIECE = re.compile(r"[A-Z]?[a-z]{3,10}|[A-Z]{4,11}")
PIECES = 8_000  # pieces in the dictionary, at most 96 kB
HELD_PIECES = 200_000  # different pieces that a task counts before it hands them on
BLOCK = 48  # bytes of a string that the coder takes at a time
BLOCK_HEADER = 3  # bytes, of the format
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
PLAIN = re.compile(r"[+/_.=-]*[A-Za-z]?[a-z]+[+/_.=-]*")  # looks like a word, if an unusual one
SENSITIVE = re.compile(r"passw|pwd|passphrase|secret|token|api.?key|access.?key|private.?key|auth|credential|bearer|signature", re.I | re.A)
# Usual words of configuration and code, the primer of the dictionary.
IDENTIFIERS = (
    "access_key access_token account admin api_key apikey application array auth authorization aws_access_key_id "
    "aws_secret_access_key base64 bearer boolean bucket build cache certificate class client client_id client_secret "
    "config configuration connection const container content credential credentials database debug default deploy "
    "description development directory docker domain email enable endpoint environment error example export false file "
    "function github google header host hostname http https id image import index input integer interface json key "
    "length license local localhost login message method module name namespace none null number object output package "
    "param parameter passphrase passwd password path port private_key production project property provider proxy public "
    "public_key query redirect region release repository request response return role root schema script secret "
    "secret_key security self server service session settings signature source staging static status storage string "
    "system table template test text this timeout timestamp token true type undefined update url user username utf-8 "
    "value variable version void webhook your_api_key_here changeme placeholder xxxxxxxx 0123456789 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ 00000000-0000-0000-0000-000000000000"
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, leftmost and not overlapping within a kind."""
    spans = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        spans += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def frequent_pieces(texts: DataFrame, size: int = PIECES) -> str:
    """The ``size`` pieces of words that stand in the most texts, two at least, most frequent last;
    ties by code point.  All texts (column text, no nulls) are counted, each piece once per text."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def hand_on() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["piece", "n"])
            held.clear()
            return out

        for batch in batches:
            for t in batch.column("text"):
                runs = {m[0] for m in RUN.finditer(t.as_py())}
                held.update({piece for run in runs for piece in PIECE.findall(run)})
                if len(held) > HELD_PIECES:
                    yield hand_on()
        yield hand_on()

    found = texts.select("text").mapInArrow(counts, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    top = found.where("n > 1").orderBy(F.desc("n"), "piece").limit(size).collect()
    return " ".join(r["piece"] for r in reversed(top))


class Novelty:
    """Marginal compressed bytes of a string after its surroundings, for a primed compressor."""

    def __init__(self, identifiers: str, level: int = 6):
        primer = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        params = zstandard.ZstdCompressionParameters.from_level(level, write_checksum=False, write_content_size=False, write_dict_id=False)
        primer.precompute_compress(compression_params=params)
        self.coder = zstandard.ZstdCompressor(dict_data=primer, compression_params=params)

    def ratio(self, text: str, start: int, end: int, around: int) -> float:
        """Bytes that the string adds after its surroundings, for each of its own.  It goes through
        the coder in blocks too short for a code of their own letters: only matches save bytes,
        so that strings of few different characters, or long ones, are judged like others."""
        stream = self.coder.compressobj()
        stream.compress((text[max(0, start - around) : start] + text[end : end + around]).encode())
        stream.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK)
        own = text[start:end].encode()
        added = 0
        for at in range(0, len(own), BLOCK):
            added += len(stream.compress(own[at : at + BLOCK])) + len(stream.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK)) - BLOCK_HEADER
        return added / len(own)


def novel_spans(text: str, taken: Sequence[tuple[int, int, str]], novelty: Novelty, least: float, around: int, reach: int) -> list[tuple[int, int, str]]:
    """Candidates in a sensitive context that no pattern has and that do not compress."""
    spans = []
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        own = m[0]
        if not any(c.isalpha() for c in own):
            continue
        if any(a < end and start < b for a, b, _ in taken):
            continue
        near = reach // 4 if PLAIN.fullmatch(own) else reach
        if not (SENSITIVE.search(text, max(0, start - near), start) or SENSITIVE.search(text, end, end + near)):
            continue
        if novelty.ratio(text, start, end, around) >= least:
            spans.append((start, end, "novel"))
    return spans


def listed(spans: Sequence[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    identifiers: str | None = None,
    least: float = 0.8,
    around: int = 256,
    reach: int = 64,
) -> DataFrame:
    """Spans of secrets in every text.

    Returns key and found: array of (kind, start, end, value) by start, then kind as listed;
    code points, end exclusive.  ``identifiers``: the dictionary; by default the fixed words above
    after the frequent pieces of this table.  ``least``: marginal compressed bytes a byte from which
    a candidate counts as incompressible; ``around``: characters on each side it is measured
    against; ``reach``: how far before or after it the sensitive word may stand, a quarter of it
    for what looks like a word.  Runs of digits alone are no candidates.  One row per input row;
    null and empty texts have no spans; null keys, repeated rows and other columns are harmless;
    an empty table gives an empty result.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if identifiers is None:
        identifiers = f"{frequent_pieces(rows)} {IDENTIFIERS}"
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(identifiers)
        for batch in batches:
            found = []
            for t in batch.column("text").to_pylist():
                base = base_spans(t)
                every = sorted([*base, *novel_spans(t, base, novelty, least, around, reach)], key=lambda s: (s[0], KINDS.index(s[2])))
                found.append([{"kind": k, "start": a, "end": b, "value": t[a:b]} for a, b, k in every])
            yield pa.record_batch([batch.column("key"), pa.array(found, pa.list_(item))], ["key", "found"])

    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(spans, f"key {kind}, found array<struct<kind string, start int, end int, value string>>")
    return out.withColumnRenamed("key", key)


def op8(spark, sf_dir: str) -> DataFrame:
    found = F.col("found")
    base = F.filter(found, lambda s: s["kind"] != "novel")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(text(base), 256).alias("base_sha256"), text(found).alias("spans")
    )


QUERIES = {"op8_secret_scan": (op8, None)}
