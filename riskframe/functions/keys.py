"""Hash expressions on stable keys.  They depend on the row alone, so a result is the
same for any number of partitions, after a retry and in a re-read of the source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "~"


def key_text(cols: Sequence[str | Column]) -> Column:
    """One text per key: every part with its length before it, and a mark without a length for
    null, so no two keys have the same text."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.concat_ws("|", *[F.coalesce(F.concat(F.length(p), F.lit(":"), p), F.lit(NULL_MARK)) for p in parts])


def hash_hex(cols: Sequence[str | Column], seed: int | None = None) -> Column:
    """32 hex digits of the key, with the seed mixed in when given."""
    text = key_text(cols)
    return F.md5(text if seed is None else F.concat(text, F.lit(f":{seed}")))


def hash_unit(cols: Sequence[str | Column], seed: int | None = None) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of the hash."""
    return F.conv(F.substring(hash_hex(cols, seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
