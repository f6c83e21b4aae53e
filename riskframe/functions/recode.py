"""Recode expressions.  Every function returns a Column, so that many recodes
go into one ``withColumns`` call and Catalyst sees a single projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fail(c: Column) -> Column:
    return F.raise_error(F.concat(F.lit("unmapped label: "), c.cast("string")))


def _miss(c: Column, unmatched: str, dtype: str) -> Column:
    """What a label outside the mapping becomes; a null label always stays null."""
    if unmatched == "null":
        return F.lit(None).cast(dtype)
    if unmatched == "error":
        return F.when(c.isNotNull(), _fail(c).cast(dtype))
    if unmatched == "keep":  # a value that is a code already, as in a second run over clean data
        return c.cast("string").try_cast(dtype)
    raise ValueError(f"unmatched must be 'null', 'error' or 'keep', got {unmatched!r}")


def unmapped(c, labels: Sequence[str]) -> Column:
    """Aggregate: rows whose value is neither null nor one of the labels."""
    c = _col(c)
    return F.count_if(c.isNotNull() & ~c.isin(list(labels)))


def recode_binary(c, true: str = "Yes", false: str = "No", unmatched: str = "null") -> Column:
    """``true`` label to 1, ``false`` label to 0, typed int.  ``unmatched``: what other labels
    become, null, an error, or (keep) themselves where they are whole numbers."""
    c = _col(c)
    return F.when(c == true, F.lit(1)).when(c == false, F.lit(0)).otherwise(_miss(c, unmatched, "int"))


def recode_binary_columns(df: DataFrame, cols: Sequence[str], true="Yes", false="No", unmatched="null") -> DataFrame:
    return df.withColumns({c: recode_binary(c, true, false, unmatched) for c in cols})


def literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for item in mapping.items() for x in item])


def ordinal_levels(levels: Sequence[str]) -> dict[str, int]:
    """Ordered labels to the codes 1..n."""
    return {level: i for i, level in enumerate(levels, start=1)}


def recode_ordinal(c, mapping: Mapping[str, int], unmatched: str = "null") -> Column:
    c = _col(c)
    code = F.try_element_at(literal_map(mapping), c).cast("int")
    if unmatched == "null":
        return code
    return F.coalesce(code, _miss(c, unmatched, "int"))


def lookup(c, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Dictionary lookup; a miss gives ``default`` (null unless set), a null stays null."""
    c = _col(c)
    found = F.try_element_at(literal_map(mapping), c)
    if default is None:
        return found
    return F.when(c.isNotNull(), F.coalesce(found, F.lit(default)))


_TESTS = {
    "equals": lambda c, text: c == text,
    "contains": lambda c, text: c.contains(text),
    "startswith": lambda c, text: c.startswith(text),
}


def recode_rules(c, rules: Sequence[tuple[str, str, str]], default: Column | None = None) -> Column:
    """Ordered ``(test, text, label)`` rules; the first match wins, otherwise ``default``
    (the value itself unless given).  Tests: equals, contains, startswith."""
    c = _col(c)
    fallback = c if default is None else default
    # built from the last rule outwards: each rule wraps the ones after it
    return reduce(
        lambda rest, rule: F.when(_TESTS[rule[0]](c, rule[1]), F.lit(rule[2])).otherwise(rest),
        reversed(rules),
        fallback,
    )


def greatest_of(*cols) -> Column:
    """Row-wise maximum that skips nulls."""
    return F.greatest(*[_col(c) for c in cols])


def recode_threeway(c, high: str, low: str) -> Column:
    """``high`` to 2, ``low`` to 0, any other label to 1, null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.when(c == high, F.lit(2)).when(c == low, F.lit(0)).otherwise(F.lit(1)))


def replace_text(c, old: str, new: str) -> Column:
    return F.replace(_col(c), F.lit(old), F.lit(new))


def canonical(c) -> Column:
    return F.trim(F.lower(_col(c)))


def replace_values(df: DataFrame, mapping: Mapping, subset: Sequence[str]) -> DataFrame:
    return df.replace(dict(mapping), subset=list(subset))


def bin_numeric(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Half-open ranges ``[edge[i-1], edge[i])`` to labels; one label more than edges."""
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must be one longer than edges")
    c = _col(c)
    ladder = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        ladder = ladder.when(c < edge, F.lit(label))
    return ladder.otherwise(F.lit(labels[-1]))


def cast_to(c, dtype: str, strict: bool = False) -> Column:
    """Cast; a value that does not parse gives null unless ``strict``."""
    c = _col(c)
    return c.cast(dtype) if strict else c.try_cast(dtype)
