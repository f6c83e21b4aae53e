"""Quotation linking: who answers whom, read off the quoted passages.

Lines are taken apart into quote depth and content.  Runs of lines of one depth are paragraphs;
paragraphs and their lines, in a normal form, are the passages that are hashed.  A quoted
passage belongs to the earliest message of the conversation that has it as own text.  The
shallowest quotation decides which message is answered; following these links upwards gives the
thread.  Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import ascii_lower, materialize, table

NEW = ["body", "quote_depth", "n_quotes", "n_linked", "parent_turn", "root_turn", "reply_depth"]
HELD = ["__lines", "__c", "__t", "__linked", "__parent", "__root", "__hops"]  # names in use inside
MARKS = r"^(?:[ \t]*>)+"
ATTRIBUTION = r"(?:wrote|writes|schrieb|a écrit|escribió)[^:]*:[ \t\r]*$"


def normal(text: Column) -> Column:
    """Lower case, single blanks, none at the ends."""
    return F.btrim(F.regexp_replace(ascii_lower(text), r"[ \t\r\n]+", " "))


def parsed(text: Column) -> Column:
    """The lines of a message: (depth, content, blank)."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    depth = lambda s: F.length(F.regexp_replace(F.regexp_extract(s, MARKS, 0), "[^>]", ""))
    content = lambda s: F.regexp_replace(s, MARKS + " ?", "")
    return F.transform(
        lines, lambda s: F.struct(depth(s).alias("depth"), content(s).alias("content"), (normal(content(s)) == "").alias("blank"))
    )


def paragraphs(lines: Column) -> Column:
    """(depth, text, lines) of every paragraph: a maximal run of lines of one depth without a blank one."""
    here = lambda i: F.element_at(lines, i)
    above = lambda i: F.element_at(lines, F.greatest(i - 1, F.lit(1)))
    begins = F.filter(
        F.sequence(F.lit(1), F.size(lines)),
        lambda i: ~here(i)["blank"] & ((i == 1) | above(i)["blank"] | (above(i)["depth"] != here(i)["depth"])),
    )
    # each paragraph reaches up to the next one; blank lines in between add nothing
    ends = F.concat(F.slice(begins, 2, F.size(begins)), F.array(F.size(lines) + 1))
    return F.transform(
        F.arrays_zip(begins.alias("a"), ends.alias("b")),
        lambda p: F.struct(
            here(p["a"])["depth"].alias("depth"),
            F.transform(F.slice(lines, p["a"], p["b"] - p["a"]), lambda s: s["content"]).alias("lines"),
        ),
    )


def passages(spans: Column) -> Column:
    """Every paragraph and every line of it in normal form: (depth, place, passage, whole)."""
    return F.flatten(
        F.transform(
            spans,
            lambda p, i: F.concat(
                F.array(F.struct(p["depth"].alias("depth"), i.alias("place"), normal(F.array_join(p["lines"], " ")).alias("passage"), F.lit(True).alias("whole"))),
                F.transform(
                    p["lines"], lambda s: F.struct(p["depth"].alias("depth"), i.alias("place"), normal(s).alias("passage"), F.lit(False).alias("whole"))
                ),
            ),
        )
    )


def own_text(lines: Column) -> Column:
    """The message without its quotes and without the lines that introduce them."""
    follows = lambda i: F.when(i < F.size(lines), F.element_at(lines, F.least(i + 1, F.size(lines)))["depth"] > 0).otherwise(False)
    kept = F.filter(
        F.sequence(F.lit(1), F.size(lines)),
        lambda i: (F.element_at(lines, i)["depth"] == 0) & ~(follows(i) & F.element_at(lines, i)["content"].rlike(ATTRIBUTION)),
    )
    return F.btrim(F.array_join(F.transform(kept, lambda i: F.element_at(lines, i)["content"]), "\n"), F.lit("\n\r\t "))


def link_quotes(
    messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", text: str = "text"
) -> DataFrame:
    """Adds to every message: body (own text), quote_depth (deepest level), n_quotes (quoted
    paragraphs), n_linked (those found, whole or by a line, in an earlier message), parent_turn
    (the message answered, null for none), root_turn (the top of its thread) and reply_depth.

    Ordering a conversation by (root_turn, turn) lists its threads with every answer after what
    it answers.  Messages are rows, not arrays, so one huge conversation is no huge row.

    A null text is empty; a null conversation or turn is never linked (root_turn is its turn);
    rows that share conversation and turn are one message for linking and each stay a row; other
    columns are kept, and replaced where they have the name of a new one.  An empty table gives
    an empty result.
    """
    messages = messages.drop(*NEW, *HELD)
    lines = parsed(F.col(text))
    ids = [F.col(conversation).alias("c"), F.col(turn).alias("t")]
    known = messages.where(F.col(conversation).isNotNull() & F.col(turn).isNotNull())
    told = known.select(*ids, lines.alias("lines")).select("c", "t", F.explode(passages(paragraphs(F.col("lines")))).alias("p"))
    units = told.where("p.passage <> ''").select("c", "t", "p.depth", "p.place", "p.whole", F.length("p.passage").alias("size"), F.md5("p.passage").alias("hash"))

    quoting = known.where(F.col(text).rlike("(?m)" + MARKS))
    asked = quoting.select(*ids, lines.alias("lines")).select("c", "t", F.explode(passages(paragraphs(F.col("lines")))).alias("p"))
    asked = asked.where("p.depth > 0 and p.passage <> ''").select(
        "c", "t", "p.depth", "p.place", F.length("p.passage").alias("size"), F.md5("p.passage").alias("hash")
    ).distinct()
    # the first message with a passage; one row per passage, so a much quoted one multiplies nothing
    first = units.where("depth = 0").groupBy("c", "hash").agg(F.min("t").alias("source"))
    found = materialize(asked.join(first, ["c", "hash"]).where("source < t"), "quote-links")

    by_source = found.groupBy("c", "t", "source").agg(F.min("depth").alias("depth"), F.sum("size").alias("size"))
    parent = by_source.groupBy("c", "t").agg(F.max(F.struct(-F.col("depth"), "size", "source"))["source"].alias("up"))
    linked = found.groupBy("c", "t").agg(F.countDistinct("place").cast("long").alias("n_linked"))
    up = materialize(parent.withColumn("hops", F.lit(1).cast("long")), "quote-parents")
    tops = up
    while True:  # every round doubles how far up a link reaches
        above = tops.select("c", F.col("t").alias("up"), F.col("up").alias("further"), F.col("hops").alias("more"))
        if tops.join(above, ["c", "up"], "left_semi").isEmpty():
            break
        tops = materialize(
            tops.join(above, ["c", "up"], "left").select("c", "t", F.coalesce("further", "up").alias("up"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops")),
            "quote-tops",
        )
    threads = up.select("c", "t", F.col("up").alias("parent")).join(tops.select("c", "t", F.col("up").alias("root"), "hops"), ["c", "t"])
    threads = threads.join(linked, ["c", "t"]).select("c", "t", "n_linked", "parent", "root", "hops").toDF(*HELD[1:])

    spans = paragraphs(F.col(HELD[0]))
    quoted = F.filter(spans, lambda p: p["depth"] > 0)
    own = [F.col(f"`{c}`") for c in messages.columns]
    depths = F.transform(F.col(HELD[0]), lambda s: s["depth"])
    rows = messages.withColumn(HELD[0], lines).select(
        *own,
        own_text(F.col(HELD[0])).alias("body"),
        F.coalesce(F.array_max(depths), F.lit(0)).cast("long").alias("quote_depth"),
        F.size(quoted).cast("long").alias("n_quotes"),
    )
    c, t, n_linked, parent, root, hops = map(F.col, HELD[1:])
    return rows.join(threads, (F.col(conversation) == c) & (F.col(turn) == t), "left").select(
        *own,
        *NEW[:3],
        F.coalesce(n_linked, F.lit(0)).cast("long").alias("n_linked"),
        parent.alias("parent_turn"),
        F.coalesce(root, F.col(turn)).alias("root_turn"),
        F.coalesce(hops, F.lit(0)).cast("long").alias("reply_depth"),
    )


def op1(spark, sf_dir: str) -> DataFrame:
    return link_quotes(table(spark, sf_dir, "conversations"))


SQL = r"""
WITH RECURSIVE messages AS (SELECT *, row_number() OVER () AS r FROM conversations),
raw AS (
  SELECT r, conv_id AS c, turn AS t, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM messages),
lines AS (
  SELECT *, len(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[^>]', '', 'g')) AS depth,
         regexp_replace(line, '^(?:[ \t]*>)+ ?', '') AS content
  FROM raw),
normal AS (
  SELECT *, trim(regexp_replace(translate(content, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\r\n]+', ' ', 'g'), ' ') AS n
  FROM lines),
begun AS (
  SELECT *, (n <> '' AND (lag(n) OVER w IS NULL OR lag(n) OVER w = '' OR lag(depth) OVER w <> depth))::INT AS begins,
         lead(depth) OVER w AS next_depth
  FROM normal WINDOW w AS (PARTITION BY r ORDER BY i)),
placed AS (SELECT *, sum(begins) OVER (PARTITION BY r ORDER BY i) AS place FROM begun),
paragraphs AS (
  SELECT r, c, t, place, any_value(depth) AS depth,
         trim(regexp_replace(string_agg(n, ' ' ORDER BY i), ' +', ' ', 'g'), ' ') AS passage
  FROM placed WHERE n <> '' GROUP BY r, c, t, place),
units AS (
  SELECT r, c, t, place, depth, passage FROM paragraphs
  UNION ALL SELECT r, c, t, place, depth, n FROM placed WHERE n <> ''),
first AS (SELECT c, passage, min(t) AS source FROM units WHERE depth = 0 AND c IS NOT NULL AND t IS NOT NULL GROUP BY c, passage),
found AS (
  SELECT DISTINCT u.c, u.t, u.depth, u.place, u.passage, f.source
  FROM units u JOIN first f ON u.c = f.c AND u.passage = f.passage WHERE u.depth > 0 AND f.source < u.t),
by_source AS (SELECT c, t, source, min(depth) AS depth, sum(len(passage)) AS size FROM found GROUP BY c, t, source),
parents AS (
  SELECT c, t, source AS up FROM (
    SELECT *, row_number() OVER (PARTITION BY c, t ORDER BY depth, size DESC, source DESC) AS k FROM by_source) WHERE k = 1),
tops AS (
  SELECT c, t, up, 1 AS hops FROM parents
  UNION ALL SELECT tops.c, tops.t, p.up, hops + 1 FROM tops JOIN parents p ON tops.c = p.c AND tops.up = p.t),
roots AS (SELECT c, t, min(up) AS root, max(hops) AS hops FROM tops GROUP BY c, t),
linked AS (SELECT c, t, count(DISTINCT place) AS n FROM found GROUP BY c, t),
bodies AS (
  SELECT r, max(depth) AS quote_depth,
         trim(coalesce(string_agg(content, chr(10) ORDER BY i) FILTER (
           depth = 0 AND NOT (coalesce(next_depth, 0) > 0
             AND regexp_matches(content, '(?:wrote|writes|schrieb|a écrit|escribió)[^:]*:[ \t\r]*$'))), ''), chr(10) || chr(13) || chr(9) || ' ') AS body
  FROM begun GROUP BY r),
quotes AS (SELECT r, count(*) FILTER (depth > 0) AS n FROM paragraphs GROUP BY r)
SELECT m.conv_id, m.turn, m.role, m.text, b.body, b.quote_depth::BIGINT AS quote_depth, coalesce(q.n, 0)::BIGINT AS n_quotes,
       coalesce(l.n, 0)::BIGINT AS n_linked, p.up AS parent_turn, coalesce(x.root, m.turn) AS root_turn, coalesce(x.hops, 0)::BIGINT AS reply_depth
FROM messages m JOIN bodies b USING (r) LEFT JOIN quotes q USING (r)
LEFT JOIN parents p ON m.conv_id = p.c AND m.turn = p.t
LEFT JOIN roots x ON m.conv_id = x.c AND m.turn = x.t
LEFT JOIN linked l ON m.conv_id = l.c AND m.turn = l.t
"""

QUERIES = {"op1_quote_links": (op1, SQL)}
