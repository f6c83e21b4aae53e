"""A Merkle manifest of a dataset whose proofs grow while the tree does.

Leaves are appended in order.  Every open run of siblings keeps, for all leaves below it, the
part of their proofs that is known; when a run is complete (or the input ends) each of its
members learns its siblings, and the run's digest is appended one level up.  Aligned blocks of
leaves are such trees of their own, in many tasks; their roots are the appends of the next
round, and the roots of the sources those of the last.  The proofs of that round are handed down
to the block, which completes the proofs of its leaves with them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskframe.llm.ordering import GROUP, PLACE, numbered, text_key
from riskframe.llm.shared import ascii_lower, materialize, table

FANOUT = 16
HEIGHT = 3  # levels of a block: 4,096 nodes
SLICE = 1_024  # rows of a batch with proofs
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "before array<string>, after array<string>"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Appender:
    """The open subtrees of a growing tree, with the partial proofs of all that was appended.

    ``proofs[i]`` lists for node i, from below, the digests before and after it in each run that
    is complete; it is shared by nothing and only ever extended.
    """

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.open: list[list[tuple[str, int, int]]] = [[]]  # by level: (digest, first node, next node)
        self.proofs: list[list[tuple[str, str]]] = []

    def append(self, node: str) -> None:
        self.proofs.append([])
        self._attach(0, (node, len(self.proofs) - 1, len(self.proofs)))

    def _attach(self, level: int, subtree: tuple[str, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(subtree)
        if len(self.open[level]) == self.fanout:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [d for d, _, _ in run]
        for j, (_, first, end) in enumerate(run):
            step = ("".join(digests[:j]), "".join(digests[j + 1 :]))
            for i in range(first, end):
                self.proofs[i].append(step)
        self._attach(level + 1, (digest(*digests), run[0][1], run[-1][2]))

    def close(self, height: int) -> str:
        """The root after ``height`` levels; what is still open is complete now."""
        for level in range(height):
            if self.open[level]:
                self._complete(level)
        ((root, _, _),) = self.open[height]
        return root


def fold(node: str, steps: list[tuple[str, str]]) -> str:
    """The root that a node and its proof give."""
    for before, after in steps:
        node = digest(before, node, after)
    return node


def _told(proofs: list[list[tuple[str, str]]]) -> list[pa.Array]:
    """The columns before and after."""
    return [pa.array([[step[side] for step in p] for p in proofs], pa.list_(pa.string())) for side in (0, 1)]


def _grown(row: dict, height: int, fanout: int) -> Appender:
    """The finished tree of a block."""
    tree = Appender(fanout)
    for node in row["nodes"]:
        tree.append(node["leaf"])
    tree.close(height_of(len(row["nodes"]), row["blocks"], height, fanout))
    return tree


def height_of(n: int, blocks: int, height: int, fanout: int) -> int:
    """Levels of a block: all of them where it is one of many, else until one node remains."""
    if blocks > 1:
        return height
    h = 0
    while fanout**h < n:
        h += 1
    return h


def leaf_of(values: list[Column]) -> Column:
    """The digest of a row: every value as its UTF-8 length and itself, or - for null."""
    told = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (c.cast("string") for c in values)]
    return F.sha2(F.concat(*told), 256)


def _blocks(nodes: DataFrame, size: int, label: str) -> DataFrame:
    """One row per aligned block of ``size`` nodes, in order: bounded, whatever the tree holds.
    ``blocks`` is how many its tree has."""
    held = [c for c in nodes.columns if c not in (GROUP, PLACE)]
    block = F.floor(F.col(PLACE) / size).cast("long")
    made = (
        nodes.withColumn("block", block)
        .groupBy(GROUP, "block")
        .agg(F.sort_array(F.collect_list(F.struct(PLACE, *held))).alias("nodes"))
    )
    made = materialize(made, f"{label}-blocks")
    counts = made.groupBy(GROUP).agg(F.count("*").alias("blocks"))
    return made.join(counts, GROUP)


def _roots(blocks: DataFrame, height: int, fanout: int, label: str) -> DataFrame:
    """(group, block, blocks, root): every block closed by itself."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = []
            for nodes, n in zip(batch.column("leaves").to_pylist(), batch.column("blocks").to_pylist()):
                tree = Appender(fanout)
                for node in nodes:
                    tree.append(node)
                roots.append(tree.close(height_of(len(nodes), n, height, fanout)))
            yield pa.record_batch([batch.column(GROUP), batch.column("block"), batch.column("blocks"), pa.array(roots, pa.string())], [GROUP, "block", "blocks", "root"])

    seen = blocks.select(GROUP, "block", "blocks", F.col("nodes.leaf").alias("leaves"))
    return materialize(seen.mapInArrow(close, f"{GROUP} string, block long, blocks long, root string"), f"{label}-roots")


def _proofs(blocks: DataFrame, above: DataFrame | None, height: int, fanout: int, label: str) -> DataFrame:
    """(group, place, before, after) of every node: its proof within the block, and that of the block."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = _grown(row, height, fanout)
                upper = list(zip(row["before"], row["after"]))
                places = [n[PLACE] for n in row["nodes"]]
                group = pa.array([row[GROUP]] * len(places), pa.string())
                yield pa.record_batch([group, pa.array(places, pa.int64()), *_told([own + upper for own in tree.proofs])], [GROUP, PLACE, "before", "after"])

    rows = _with_proof(blocks, above)
    return materialize(rows.mapInArrow(extend, f"{GROUP} string, {PLACE} long, {PROOF}"), f"{label}-proofs")


def _with_proof(blocks: DataFrame, above: DataFrame | None) -> DataFrame:
    """Adds the proofs that the round above found for the blocks; empty where a tree has one block."""
    none = F.array().cast("array<string>")
    if above is None:
        return blocks.withColumns({"before": none, "after": none})
    found = above.select(GROUP, F.col(PLACE).alias("block"), "before", "after")
    return blocks.join(found, [GROUP, "block"], "left").withColumns({c: F.coalesce(c, none) for c in ("before", "after")})


def grow(nodes: DataFrame, height: int, fanout: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of appends: (the blocks of every round, the root of every tree).

    ``nodes``: group, place, leaf, and what else the first round's blocks are to hold.  Every
    round leaves one node of ``fanout ** height``; a tree of one block is finished and takes no
    further part.
    """
    size, rounds, finished = fanout**height, [], None
    while True:
        blocks = _blocks(nodes, size, label)
        roots = _roots(blocks, height, fanout, label)
        rounds.append(blocks)
        done = roots.where("blocks = 1").select(GROUP, "root")
        finished = done if finished is None else finished.unionByName(done)
        if roots.where("blocks > 1").isEmpty():
            return rounds, finished
        nodes = roots.where("blocks > 1").select(GROUP, F.col("block").alias(PLACE), F.col("root").alias("leaf"))


def handed_down(rounds: list[DataFrame], height: int, fanout: int, label: str) -> DataFrame | None:
    """The proofs of the first round's blocks in their trees; None where no tree has two."""
    above = None
    for blocks in reversed(rounds[1:]):
        above = _proofs(blocks, above, height, fanout, label)
    return above


def manifest(
    docs: DataFrame,
    changed: Column | None = None,
    columns: tuple[str, ...] = COLUMNS,
    key: str = "doc_id",
    source: str = "source",
    fanout: int = FANOUT,
    height: int = HEIGHT,
) -> DataFrame:
    """A leaf, a proof and a check for every row.

    Returns key, leaf, subroot, root, before and after (the proof: for each level from below the
    joined digests before and after) and folded_root: what the leaf of the row as it is now
    gives with that proof.  ``changed``:
    an array of columns' values that stand for the row now, null where it is unchanged.

    Leaves ascend by key within a source, nulls first, and by digest where keys are equal; equal
    rows are leaves of their own.  A null source is a source.  Rows of any other columns, empty
    and null texts are digested as they are; a long text is read once, where it lies, and only
    digests travel.  An empty table gives an empty result.
    """
    now = F.lit(None).cast("string") if changed is None else F.when(changed.isNotNull(), leaf_of([changed[i] for i in range(len(columns))]))
    leaves = docs.select(
        text_key(F.col(f"`{source}`")).alias(GROUP),
        F.col(f"`{key}`").alias("key"),
        leaf_of([F.col(f"`{c}`") for c in columns]).alias("leaf"),
        now.alias("now"),
    )
    placed = numbered(materialize(leaves, "merkle-leaves"), ["key", "leaf"], "merkle-order")
    rounds, subroots = grow(placed, height, fanout, "merkle")
    # the sources' roots are the leaves of one more tree
    tops = numbered(subroots.select(F.lit("all").alias(GROUP), F.col(GROUP).alias("name"), F.col("root").alias("leaf")), ["name"], "merkle-sources")
    top_rounds, roots = grow(tops, height, fanout, "merkle-top")
    proven = _proofs(top_rounds[0], handed_down(top_rounds, height, fanout, "merkle-top"), height, fanout, "merkle-top")
    of_sources = tops.join(proven, [GROUP, PLACE]).select(
        F.col("name").alias(GROUP), F.col("leaf").alias("subroot"), F.col("before").alias("top_before"), F.col("after").alias("top_after")
    )
    blocks = _with_proof(rounds[0].join(of_sources, GROUP), handed_down(rounds, height, fanout, "merkle"))
    key_type = to_arrow_type(docs.schema[key].dataType)

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes = row["nodes"]
                upper = list(zip([*row["before"], *row["top_before"]], [*row["after"], *row["top_after"]]))
                proofs = [own + upper for own in _grown(row, height, fanout).proofs]
                for a in range(0, len(nodes), SLICE):
                    some, known = nodes[a : a + SLICE], proofs[a : a + SLICE]
                    yield pa.record_batch(
                        [
                            pa.array([n["key"] for n in some], key_type),
                            pa.array([n["leaf"] for n in some], pa.string()),
                            pa.array([row["subroot"]] * len(some), pa.string()),
                            *_told(known),
                            pa.array([fold(n["now"] or n["leaf"], p) for n, p in zip(some, known)], pa.string()),
                        ],
                        ["key", "leaf", "subroot", "before", "after", "folded_root"],
                    )

    kind = docs.schema[key].dataType.simpleString()
    out = blocks.mapInArrow(complete, f"key {kind}, leaf string, subroot string, {PROOF}, folded_root string")
    first = roots.first()
    root = F.lit(first["root"] if first else None).cast("string")
    return out.select(F.col("key").alias(key), "leaf", "subroot", root.alias("root"), "before", "after", "folded_root")


def op11(spark, sf_dir: str) -> DataFrame:
    values = [F.col(c).cast("string") for c in COLUMNS[:-1]]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.array(*values, ascii_lower(F.col("text"))))
    siblings = F.flatten(F.zip_with("before", "after", lambda b, a: F.array(b, a)))
    return manifest(table(spark, sf_dir, "documents"), tampered).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        "folded_root",
        F.expr("folded_root = root").alias("verified"),
    )


LEVELS = 8  # levels written out in the SQL: up to 16 ** 8 leaves in a source, and as many sources


def _sql() -> str:
    crc = (
        "xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda t: ord(t)::BIGINT), "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"
    )
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = lambda text: "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"
    parts = [
        f"rows AS (SELECT doc_id, source AS g, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} END AS now FROM documents)",
        "numbered AS (SELECT row_number() OVER () AS r, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, * FROM rows)",
        "s0 AS (SELECT g, p, leaf AS h FROM numbered)",
    ]
    for tree, top in (("s", LEVELS), ("t", LEVELS)):
        if tree == "t":
            parts.append(f"t0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS p, h, g AS source FROM s{top})")
        for i in range(top):
            # a finished tree has one node and stays as it is
            parts.append(
                f"{tree}{i + 1} AS (SELECT g, p // 16 AS p, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h "
                f"FROM (SELECT g, p, h, count(*) OVER (PARTITION BY g) AS n FROM {tree}{i}) GROUP BY g, p // 16)"
            )
            parts.append(
                f"{tree}p{i} AS (SELECT a.g, a.p, coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS before, "
                f"coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS after, max(n) > 1 AS counts "
                f"FROM {tree}{i} a JOIN (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {tree}{i}) b ON a.g IS NOT DISTINCT FROM b.g AND a.p // 16 = b.p // 16 GROUP BY a.g, a.p)"
            )
    parts.append("w0 AS (SELECT n.r, n.doc_id, n.leaf, n.g, n.p, t.p AS q, coalesce(n.now, n.leaf) AS h, '' AS proof, s.h AS subroot "
                 f"FROM numbered n JOIN s{LEVELS} s ON n.g IS NOT DISTINCT FROM s.g JOIN t0 t ON n.g IS NOT DISTINCT FROM t.source)")
    k = 0
    for tree, place, match in (("s", "p", "w.g IS NOT DISTINCT FROM x.g AND w.p = x.p"), ("t", "q", "w.q = x.p")):
        for i in range(LEVELS):
            parts.append(
                f"w{k + 1} AS (SELECT w.* REPLACE (w.{place} // 16 AS {place}, CASE WHEN counts THEN sha256(before || h || after) ELSE h END AS h, "
                f"CASE WHEN counts THEN proof || before || after ELSE proof END AS proof) FROM w{k} w JOIN {tree}p{i} x ON {match})"
            )
            k += 1
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, w.h AS folded_root, w.h = t.h AS verified "
        f"FROM w{k} w CROSS JOIN t{LEVELS} t"
    )


QUERIES = {"op11_merkle_manifest": (op11, _sql())}
