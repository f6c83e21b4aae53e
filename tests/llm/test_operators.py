"""The training-data operators against brute force, and on awkward rows."""

import base64
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from riskframe.llm import (
    binary_codes,
    cotraining,
    decontaminate,
    jaccard_join,
    mixture,
    quote_links,
    secret_scan,
    suffix_dedup,
    token_lattice,
    training_order,
)
from riskframe.llm.shared import components

DOCS = T.StructType(
    [T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()))]
)
# names that the operators use inside or return
EXTRA = ["key", "size", "node", "copies", "taken", "score", "kept", "component", "n", "items", "__id", "w", "hash", "block"]
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def frame(spark, rows):
    """Documents with extra columns of clashing names."""
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    return df.select("*", *[F.lit("x").alias(c) for c in EXTRA])


def awkward(spark):
    """Nulls everywhere, empty and long texts, blanks only, ties and repeated rows."""
    long = " ".join(f"w{i * 7919 % 4001}" for i in range(30_000))
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one", "b"), (5, long, "b"), (6, long, None),
        (7, "one two three four five six", "a"), (8, "ONE two three FOUR five six", "a"), (8, "ONE two three FOUR five six", "a"),
        (None, "one two three four five six", "a"), (None, None, None), (9, "ß ſecret=ABCDEFGHIJ K \x1c x", "c"),
    ]
    return frame(spark, rows)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components_of_a_chain_a_star_and_loops(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(7, 7), (9, 8), (8, 9)]
    pairs += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(180)]
    rng.shuffle(pairs)
    df = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    want = roots(pairs, {n for p in pairs for n in p})
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {n: c for n, c in want.items() if n in got}
    assert set(got) == {n for a, b in pairs for n in (a, b) if a != b}
    assert components(df.limit(0)).count() == 0


# ---- 1 ----


def test_quotes_link_and_order(spark):
    rows = [
        (1, 0, "Shall we meet\non Monday?"),
        (1, 1, "On Tue, Ann wrote:\n> Shall we  meet\n> on monday?\n\nYes."),
        (1, 2, "> > Shall we meet on Monday?\n> Yes.\nGood."),
        (1, 3, "> on Monday?\nNot me"),
        (1, 4, "> never said"),
        (2, 0, "> Shall we meet on Monday?\nwhat"),
        (None, 1, "> Yes."), (2, None, None), (2, 1, ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string").withColumn("parent", F.lit(1)).withColumn("body", F.lit("old"))
    got = {(r.conv_id, r.turn): r for r in quote_links.link_quotes(df).collect()}
    pick = lambda k: (got[k].parent_turn, got[k].root_turn, got[k].reply_depth, got[k].n_quotes, got[k].n_linked, got[k].quote_depth)
    assert pick((1, 0)) == (None, 0, 0, 0, 0, 0)
    assert pick((1, 1)) == (0, 0, 1, 1, 1, 1) and got[1, 1].body == "Yes."
    assert pick((1, 2)) == (1, 0, 2, 2, 2, 2) and got[1, 2].body == "Good."
    assert pick((1, 3)) == (0, 0, 1, 1, 1, 1)
    assert pick((1, 4)) == (None, 4, 0, 1, 0, 1) and got[1, 4].body == ""
    assert pick((2, 0))[:1] == (None,)
    assert pick((None, 1))[:2] == (None, 1) and got[2, None].body == ""
    assert len(got) == len(rows)
    assert quote_links.link_quotes(df.limit(0)).count() == 0


def test_quotes_equal_their_sql(spark, tmp_path):
    import duckdb

    from tests.oracle import compare

    rng, said = random.Random(5), []
    for c in range(6):
        texts = []
        for t in range(8):
            own = "\n".join(rng.choice(["red fox", "Blue  sky", "", "green tea", "x"]) + f" {rng.randrange(4)}" for _ in range(3))
            quotes = "\n".join("> " + line for line in rng.choice(texts).split("\n")) if texts and rng.random() < 0.8 else ""
            texts.append(quotes + ("\n\n" if rng.random() < 0.5 else "\n") + own)
            said.append((c, t, "user", texts[-1]))
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    assert compare(quote_links.link_quotes(df), con, quote_links.SQL) is None


# ---- 2 ----


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 24))
    near = base[rng.integers(0, 60, 1500)] + 0.08 * rng.standard_normal((1500, 24))
    hot = base[299] + 0.05 * rng.standard_normal((1500, 24))
    v = np.concatenate([base, near, hot, base[:5]]).astype(np.float32)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    n = len(rows)
    odd = [(n, None), (n + 1, [0.0] * 24), (n + 2, [float("nan")] + [1.0] * 23), (n + 3, [None] + [1.0] * 23), (n + 4, [1.0, 0.0]), (n + 5, []), (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("node", F.lit(1))
    unit = v.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    want = roots(zip(*(x.tolist() for x in np.nonzero(np.triu(linked)))), range(n))
    got = {r.vec_id: r for r in binary_codes.near_vectors(df).collect()}
    assert len(got) == n + 7
    links = np.array([got[i].n_links for i in range(n)])
    assert (links <= linked.sum(1)).all() and links.sum() >= 0.999 * linked.sum()
    assert sum(got[i].component_id != want[i] for i in range(n)) <= 2
    assert all((got[k].n_links, got[k].component_id) == (0, k) for k, _ in odd)
    assert binary_codes.near_vectors(df.limit(0)).count() == 0


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    coder = binary_codes.Coder(64, 2, 8, 0.95, 5.0)
    x = rng.standard_normal((400, 64))
    y = x + rng.standard_normal((400, 64)) * rng.uniform(0.1, 2, (400, 1))
    x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
    factor = coder.factors(x)
    estimate = np.einsum("ij,ij->i", coder.scaled(coder.codes(x), factor), y @ coder.rotations)
    error = estimate - (x * y).sum(1)
    assert abs(error.mean()) < 0.01
    assert (np.abs(error) <= coder.bound(factor)).all()


@pytest.mark.parametrize("vectors", [2_000, 10**5, 10**6, 10**8])
def test_tables_find_pairs_at_the_threshold(vectors):
    rng = np.random.default_rng(3)
    bits, tables = binary_codes.table_plan(vectors, 0.95, 0.001)
    coder = binary_codes.Coder(64, tables, bits, 0.95, 5.0)
    x, y = rng.standard_normal((2, 20_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(1)[:, None] * x
    y = 0.9501 * x + np.sqrt(1 - 0.9501**2) * y / np.linalg.norm(y, axis=1)[:, None]
    missed = ~(coder.buckets(x.astype(np.float32)) == coder.buckets(y.astype(np.float32))).any(1)
    print(f"{vectors} vectors: {bits} bits, {tables} tables, {100 * missed.mean():.3f} % of pairs at 0.9501 missed")
    assert missed.mean() <= 0.002


def test_buckets_do_not_hang_on_the_batch():
    rng = np.random.default_rng(4)
    coder = binary_codes.Coder(64, 30, 20, 0.95, 5.0)
    x = rng.standard_normal((3000, 64)).astype(np.float32)
    whole = coder.buckets(x)
    assert all((coder.buckets(x[i : i + n].astype(np.float64)) == whole[i : i + n]).all() for i, n in ((0, 1), (5, 7), (1000, 1500)))


# ---- 3 ----


def brute_repeats(docs, length=100):
    seen, out = set(), {}
    for k, t in sorted(docs):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            else:
                seen.add(s)
        out[k] = (sum(gone), bytes(b for b, g in zip(raw, gone) if not g))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_repeats_against_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(10, 40))) for _ in range(12)]
    texts = []
    for _ in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.6 else " ".join(word() for _ in range(20)) for _ in range(rng.randint(0, 6))]
        t = " ".join(parts)
        if rng.random() < 0.3 and t:
            at = rng.randrange(len(t))
            t = t[:at] + word() + t[at + rng.randint(0, 5) :]
        texts.append(t)
    texts += ["ab" * 300, "of " * 150, texts[3], texts[3], "z" * 99, "z" * 100, "z" * 101]
    docs = list(enumerate(texts)) + [(900, None)]
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(frame(spark, [(i, t, "a") for i, t in docs]).repartition(5), sample=40).collect()}
    for k, (gone, kept) in brute_repeats(docs).items():
        assert sum(s.end - s.begin for s in got[k].spans or ()) == gone and bytes(got[k].kept) == kept, k


def test_multikey_runs():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, (400, 11)).astype(np.uint8)
    order, new = suffix_dedup.multikey_runs(data, np.arange(400)[::-1].copy(), np.zeros(400, np.int64))
    rows = [bytes(r) for r in data]
    assert [rows[i] for i in order] == sorted(rows) and new.sum() == len(set(rows))
    assert all(399 - order[i] > 399 - order[i - 1] for i in range(1, 400) if not new[i])


# ---- 4 ----


def shingles(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if c < "\x80" else c for c in text or "")) if x]
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def test_jaccard_against_all_pairs(spark):
    rng = random.Random(8)
    lexicon = [f"w{i}" for i in range(400)]
    base = [[rng.choice(lexicon) for _ in range(rng.randint(4, 120))] for _ in range(60)]
    shared = [rng.choice(lexicon) for _ in range(50)]
    texts = []
    for _ in range(700):
        w = list(rng.choice(base[:15] if rng.random() < 0.6 else base))
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(lexicon)
        texts.append(" ".join(w + (shared if rng.random() < 0.2 else [])))
    texts += ["one", "ONE", "two three", "two  three", "", None, " "]
    sets = [shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    want = roots(pairs, range(len(texts)))
    df = frame(spark, [(i, t, "a") for i, t in enumerate(texts)]).repartition(4)
    for sample in (4000, 10):
        got = {r.doc_id: r for r in jaccard_join.jaccard_components(df, sample_rows=sample).collect()}
        assert {k: r.component_id for k, r in got.items()} == want
        assert all(got[i].n_shingles == len(s) for i, s in enumerate(sets))


def test_region_links_across_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    test_jaccard_against_all_pairs(spark)


# ---- 5 ----


def test_leaks(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(6))
    items = [[word() for _ in range(30)] for _ in range(5)] + [["tiny", "item", "here"]]
    prose = lambda n: [word() for _ in range(n)]
    edited = items[1].copy()
    edited[-2] = "changed"
    far = items[2].copy()
    for i in (3, 9, 15, 21, 27):
        far[i] = "x"
    rows = [
        (1, " ".join(prose(50) + items[0] + prose(40))), (2, " ".join(prose(5) + edited).upper()), (3, " ".join(prose(9) + far)),
        (4, " ".join(prose(80))), (5, " ".join(items[3] + prose(3) + items[4])), (6, "a Tiny item\there b"), (7, "tiny item gone"),
        (8, None), (9, ""), (None, " ".join(items[0])), (1, "again"),
    ]
    docs = frame(spark, [(i, t, "a") for i, t in rows])
    bench = spark.createDataFrame([*[(i, " ".join(w)) for i, w in enumerate(items)], (9, None), (10, " ")], "item_id long, text string")
    got = {r.doc_id: list(r["items"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {1: [0], 2: [1], 5: [3, 4], 6: [5], None: [0]}
    marked = decontaminate.marked(docs, decontaminate.find_leaks(docs, bench))
    assert marked.count() == len(rows) and marked.where("contaminated").count() == 6
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0


def test_blocks_find_all_within_the_radius(spark):
    rng = random.Random(4)
    rows = []
    for i in range(200):
        x, d = rng.getrandbits(64), rng.randint(0, 24)
        y = x
        for b in rng.sample(range(64), d):
            y ^= 1 << b
        rows.append((i, x - (1 << 63), y - (1 << 63)))
    df = spark.createDataFrame(rows, "i long, x long, y long")
    agree = F.arrays_overlap(decontaminate.blocks(F.col("x"), 24), decontaminate.blocks(F.col("y"), 24))
    assert df.where(agree).count() == 200


def test_shingles_are_numbered_by_occurrence_in_texts_of_any_length(spark):
    rng = random.Random(4)
    texts = [[rng.choice("abc") for _ in range(n)] for n in (1, 2, 3, 30)] + [["a"] * 50, [rng.choice(["x", "y\u00e9", "zz"]) for _ in range(20_000)]]
    rows = spark.createDataFrame([(i, w, min(5, len(w))) for i, w in enumerate(texts)], "i int, w array<string>, width int")
    for r in rows.select("i", "width", decontaminate.counted(F.col("w"), F.col("width")).alias("got")).collect():
        w, seen, want = texts[r["i"]], {}, []
        for at in range(max(len(w) - r["width"] + 1, 1)):
            shingle = " ".join(w[at : at + r["width"]])
            seen[shingle] = seen.get(shingle, 0) + 1
            want.append(f"{shingle}\n{seen[shingle]}")
        assert sorted(r["got"]) == sorted(want)


def test_long_items_are_found(spark):
    rng = random.Random(9)
    item = [f"w{rng.randrange(5_000)}" for _ in range(8_000)]
    near = ["changed" if i % 100 == 0 else w for i, w in enumerate(item)]
    far = ["changed" if i % 10 == 0 else w for i, w in enumerate(item)]
    docs = spark.createDataFrame([(i, " ".join(["before"] * 50 + w + ["after"] * 50)) for i, w in enumerate((item, near, far))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: list(r["items"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {0: [7], 1: [7]}


def test_every_window_of_a_text_is_looked_at(spark):
    """Windows whose beginning no shared shingle puts there: exchanged halves, words put in."""
    rng = random.Random(12)
    item = [f"w{i}" for i in range(100)]
    rest = lambda n: [f"r{rng.randrange(10**6)}" for _ in range(n)]
    swapped = rest(60) + item[50:] + item[:50] + rest(60)
    widened = rest(60) + item[:33] + ["in"] + item[33:66] + ["out"] + item[66:] + rest(60)
    cut = rest(60) + item[50:] + rest(20) + item[:50] + rest(60)
    short = item[45:] + item[5:45]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate((swapped, widened, cut, short, rest(300)))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: list(r["items"]) for r in decontaminate.find_leaks(docs, bench).collect()}

    def leaks(w):
        """Brute force over all windows."""
        count = lambda v: Counter(tuple(v[i : i + 5]) for i in range(len(v) - 4))
        for b in range(max(len(w) - len(item), 0) + 1):
            one, other = count(w[b : b + len(item)]), count(item)
            shared = (one & other).total()
            if 100 * shared >= 80 * (one.total() + other.total() - shared):
                return True
        return False

    assert got == {i: [7] for i, w in enumerate((swapped, widened, cut, short)) if leaks(w)}
    assert 0 in got


def holds(w, item):
    """Brute force: whether a window of the item's length has 80 % similarity to it."""
    width = min(5, len(item))
    count = lambda v: Counter(tuple(v[i : i + width]) for i in range(len(v) - width + 1))
    for b in range(max(len(w) - len(item), 0) + 1):
        one, other = count(w[b : b + len(item)]), count(item)
        shared = (one & other).total()
        if shared and 100 * shared >= 80 * (one.total() + other.total() - shared):
            return True
    return False


def drill(rng):
    """A text of few different shingles: two to four words over and over, a slip at times."""
    period, n, at = rng.randint(2, 4), rng.randint(18, 60), rng.randrange(4)
    return [rng.choice("ab") if rng.random() < 0.01 else "abcd"[(at + i) % period] for i in range(n)]


def test_similar_texts_are_found_however_far_their_fingerprints(spark):
    """Two halves that vote about as often decide a fingerprint's bit by one shingle more."""
    rng = random.Random(21)
    items = [["a", "b"] * 10 + ["a"], [*"abc"] * 7, *[drill(rng) for _ in range(30)]]
    texts = [["b", "a"] * 10 + ["b"], [f"w{i}" for i in range(9)], *[drill(rng) for _ in range(120)]]
    want = {i: found for i, w in enumerate(texts) if (found := [j for j, item in enumerate(items) if holds(w, item)])}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: list(r["items"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert 0 in want[0] and 1 not in want
    assert got == want


def test_firm_bits_are_the_same_in_every_similar_text(spark):
    rng = random.Random(22)
    texts = [drill(rng) for _ in range(80)]
    count = lambda v: Counter(tuple(v[i : i + 5]) for i in range(len(v) - 4))
    df = spark.createDataFrame([(i, w) for i, w in enumerate(texts)], "i int, w array<string>").withColumn("own", decontaminate.hashes(F.col("w"), F.lit(5)))
    rows = df.select("i", decontaminate.simhash("own").alias("print"), decontaminate.firm("own", 80).alias("firm")).collect()
    similar, told = 0, 0
    for x in rows:
        for y in rows:
            item, window = count(texts[x.i]), count(texts[y.i])
            if window.total() <= item.total():
                shared, apart = (item & window).total(), (x.print ^ y.print) & x.firm
                if 100 * shared >= 80 * (item.total() + window.total() - shared):
                    similar += 1
                    assert apart == 0
                else:
                    told += apart != 0
    assert similar > 80 and told > 80


def test_items_without_an_id_are_found(spark):
    one, other, both = ([f"{x}{i}" for i in range(20)] for x in "xyz")
    docs = spark.createDataFrame([(1, " ".join(one)), (2, " ".join(one + both + other)), (3, " ".join(both)), (4, "none of these")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, " ".join(one)), (None, " ".join(other)), (5, " ".join(both))], "item_id long, text string")
    found = decontaminate.find_leaks(docs, bench)
    assert {r.doc_id: (r.n_items, list(r["items"])) for r in found.collect()} == {1: (1, [None]), 2: (2, [None, 5]), 3: (1, [5])}
    assert decontaminate.marked(docs, found).where("contaminated").count() == 3


# ---- 6 ----


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = cotraining.quality_labels(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    seen = F.pmod("doc_id", F.lit(2)) == 0
    model = cotraining.fit_quality(docs, labels.where(seen), labelled_rows=2000)
    assert sum(map(sum, model.rounds)) > 0
    again = cotraining.fit_quality(docs.repartition(3), labels.where(seen), labelled_rows=2000)
    assert np.allclose(again.mix, model.mix, atol=1e-3)
    scored = cotraining.score_quality(docs, model).join(labels.where(~seen), "doc_id")
    rates = {r.label: r.kept for r in scored.groupBy("label").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1] > 0.985 and rates[0] < 0.2


def test_quality_on_awkward_rows(spark):
    docs = awkward(spark).withColumn("lang", F.when(F.col("doc_id") > 3, F.col("lang")))
    few = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1)], "doc_id long, label int")
    assert cotraining.fit_quality(docs, few) is None
    assert cotraining.score_quality(docs, None).where("kept").count() == docs.count()
    more = spark.createDataFrame([(i, "good words here " * 5 if i % 2 else "BAD!! " * 9) for i in range(200)], "doc_id long, text string")
    more = more.select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"))
    model = cotraining.fit_quality(more, more.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label")))
    out = cotraining.score_quality(docs, model)
    assert out.count() == docs.count() and out.where("score is null").count() == 0
    assert cotraining.score_quality(docs.limit(0), model).count() == 0
    good = cotraining.score_quality(more, model).where("kept").select("doc_id").collect()
    assert {r.doc_id for r in good} == set(range(1, 200, 2))


# ---- 7 ----


def test_token_counts_equal_the_library(spark):
    library = Tokenizer.from_file(JSON)
    rng = random.Random(1)
    alpha = ["a", "the", " ", "  ", "\n", "\t", "'s", "'re", "'r", "'", "1", "23", "!", "...", "é", "日本", "　", "\xa0", "<|endoftext|>", " 'll", "\r\n", "🙂", "ing", " tion", "\x1c", "\x85"]
    texts = ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["x" * 5000, " " * 3000, "".join(texts), "<|endoftext|>" * 50]
    rows = [(i, t, "a") for i, t in enumerate(texts)] + [(len(texts), None, "a"), (None, "ab", "a"), (3, texts[3], "a")]
    want = sorted((-1 if i is None else i, len(library.encode(t or "", add_special_tokens=False).ids), len((t or "").encode())) for i, t, _ in rows)
    for chunk in (1 << 16, 64):
        got = token_lattice.token_counts(frame(spark, rows), JSON, chunk=chunk).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_bytes) for r in got) == want
    assert {r.over_limit for r in got if r.n_tokens > 1024} == {True}
    assert token_lattice.token_counts(empty(spark), JSON).count() == 0


def test_transducer_classes_and_a_full_table():
    library = Tokenizer.from_file(JSON)
    machine = token_lattice.transducer(open(JSON, encoding="utf-8").read())
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 1 << 16):
        text = "".join("a" + c + "b" for c in every[at : at + (1 << 16)])
        assert machine.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    limit, machine.limit = machine.limit, 100
    text = "Never the less it counts, whatever the table's size was."
    assert machine.count(text) == machine.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    machine.limit = limit


# ---- 8 ----


def brute_secrets(t):
    kinds = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), ("access", r"AKIA[A-Z0-9]+", 0), ("hex", r"[0-9a-f]+", 0)]
    long = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
    found = [(*m.span(), k) for k, p, f in kinds for m in re.finditer(p, t or "", f) if long[k](m)]
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(found, key=lambda s: (s[0], [k for k, _, _ in kinds].index(s[2]))))


def test_secrets(spark):
    rng = random.Random(6)
    bits = ["password", "Secret", "TOKEN", "api_key", "apikey", "ſecret", "toKen", "=", ":", " ", '"', "'", "abc", "abcdef12", "AKIA", "ABCDEF1234567890", "0123456789abcdef", "deadbeef", "ü", "\n", "x", "== "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    key = "q7Zp2XvR9mK4tLw8YbN3cHs6JdGf1AeU"
    texts += [f"the private key is {key} now", "see the auth config_file_path_value_2_default_config_file here", None, ""]
    rows = [(i, t, "a") for i, t in enumerate(texts)]
    got = {r.doc_id: r.found for r in secret_scan.scan(frame(spark, rows)).collect()}
    text = lambda spans: ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)
    for i, t in enumerate(texts):
        assert text([s for s in got[i] if s.kind != "novel"]) == brute_secrets(t), t
        assert all(s.value == t[s.start : s.end] for s in got[i])
    assert [(s.kind, s.value) for s in got[800]] == [("novel", key)]
    assert got[801] == [] == got[802] == got[803]
    assert secret_scan.scan(awkward(spark)).count() == awkward(spark).count()
    assert secret_scan.scan(empty(spark)).count() == 0


def test_secrets_of_any_alphabet_are_found_and_words_are_not(spark):
    rng = random.Random(8)
    vocabulary = ["responsibility", "configuration", "notwithstanding", "documentation", "the", "of", "value", "settings", "a", "was", "with"]
    prose = lambda: " ".join(rng.choice(vocabulary) for _ in range(60))
    alphabets = ["abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"]
    planted, rows = {}, []
    for i in range(300):
        key = "".join(rng.choice(alphabets[i % 3]) for _ in range(16 + i % 25))
        planted[i] = key
        rows.append((i, f"{prose()} bearer {key} {prose()}" if i % 2 else f"{prose()} {key} is the credential {prose()}", "a"))
    rows += [(1000 + i, f"{prose()} token {prose()} auth 123456789012345 {prose()} secret", "a") for i in range(300)]
    # a copied secret does not become a usual word
    rows += [(2000 + i, f"{prose()} bearer QxZbVnMkLpTrWsYdFgHjKcXeRu {prose()}", "a") for i in range(200)]
    got = {r.doc_id: [s.value for s in r.found if s.kind == "novel"] for r in secret_scan.scan(frame(spark, rows)).collect()}
    assert sum(got[i] == [key] for i, key in planted.items()) >= 285
    assert sum(bool(got[1000 + i]) for i in range(300)) <= 6  # 2 % of texts full of long words beside sensitive ones
    assert sum(got[2000 + i] == ["QxZbVnMkLpTrWsYdFgHjKcXeRu"] for i in range(200)) >= 195


def test_pieces_are_counted_once_a_text_in_all_texts(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "HELD_PIECES", 2)
    texts = ["alpha alpha alpha beta", "beta gammaDelta Q1alpha", "beta GAMMA alpha", "", "responsibilities", "gammaDelta responsibilities aXbYcZdefg"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    assert secret_scan.frequent_pieces(rows, 3) == "alpha Delta beta"
    assert secret_scan.frequent_pieces(rows) == "responsibi lities gamma alpha Delta beta"
    assert secret_scan.RUN.search("a" * 100_000 + "1") is None


# ---- 9 ----


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    p = training_order.Feistel(n, 9)
    slots = p.slots(np.arange(n))
    assert sorted(slots) == list(range(n))
    assert (p.indexes(slots) == np.arange(n)).all()
    if n > 100:
        assert (slots != training_order.Feistel(n, 10).slots(np.arange(n))).any()


def test_training_order_round_trip(spark, tmp_path):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    coder = training_order.tokenizer(ranks, public_tokenizers.PATTERN)
    docs = awkward(spark)
    length, per_shard = 128, 16
    make = lambda df: training_order.training_order(df, RANKS, public_tokenizers.PATTERN, 50256, length=length, per_shard=per_shard)
    out = make(docs)
    rows = out.collect()
    assert [r.slot for r in sorted(rows, key=lambda r: r.slot)] == list(range(len(rows)))
    assert all(len(r.ids) == 2 * length and r.shard == r.slot // per_shard and r.byte_offset == r.slot % per_shard * 2 * length for r in rows)
    parts = {}
    for r in rows:
        parts.setdefault(r.doc_id, []).append((r.part, np.frombuffer(r.ids, "<u2")[: r.n_tokens].tolist()))
    for k, t in [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None and r.doc_id != 8]:
        ids = [i for _, own in sorted(parts[k]) for i in own]
        assert ids == [*coder.encode_ordinary(t or ""), 50256]
    assert len(parts[8]) == 2 and len(parts[None]) == 2
    training_order.write_shards(out, str(tmp_path / "s"))
    start = len(rows) // 2
    again = {r.slot: bytes(r.ids) for r in training_order.read_from(spark, str(tmp_path / "s"), start, length, per_shard).collect()}
    assert again == {r.slot: bytes(r.ids) for r in rows if r.slot >= start}
    assert make(empty(spark)).count() == 0


def test_shards_are_written_whole_and_read_back(spark):
    import glob

    from riskframe.sources.scratch import scratch_root

    texts = [(None if i % 50 == 0 else i, " ".join(f"w{i * j % 97}" for j in range(i % 40)), "a") for i in range(400)]
    docs = frame(spark, texts + texts[:5])
    how = dict(end_id=50256, length=16, per_shard=32)
    before = set(glob.glob(f"{scratch_root(spark)}/riskframe/shards-*"))
    got = training_order.written_order(docs, RANKS, public_tokenizers.PATTERN, **how)
    want = training_order.training_order(docs, RANKS, public_tokenizers.PATTERN, **how)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    (path,) = set(glob.glob(f"{scratch_root(spark)}/riskframe/shards-*")) - before
    total, sizes = want.count(), {}
    for r in spark.read.parquet(path).collect():  # more shards than tasks, and not a multiple of them
        assert r.shard not in sizes and r.first_slot == 32 * r.shard and len(r.data) == 32 * r.n_sequences
        sizes[r.shard] = r.n_sequences
    assert len(sizes) > 8 and len(sizes) % 8
    assert [sizes[i] for i in range(len(sizes))] == [32] * (total // 32) + [total % 32] * (total % 32 > 0)
    ids = {r.slot: bytes(r.ids) for r in want.collect()}
    assert {r.slot: bytes(r.ids) for r in training_order.read_from(spark, path, 70, 16, 32).collect()} == {k: v for k, v in ids.items() if k >= 70}
    short = f"{path}-short"
    spark.read.parquet(path).where("shard <> 3").write.parquet(short)
    with pytest.raises(RuntimeError):
        training_order.from_shards(spark, short, "doc_id", "bigint", 16, 32)
    assert training_order.written_order(empty(spark), RANKS, public_tokenizers.PATTERN, **how).count() == 0


# ---- 10 ----


def filled(sizes, weights, cap):
    """Targets by sharing out again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        rate = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in rest))
        above = [s for s in rest if rate * weight[s] > cap * sizes[s]]
        if not above:
            return {s: fixed.get(s, rate * weight[s]) for s in order}
        fixed |= {s: cap * sizes[s] for s in above}


def test_mixture(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "c", "Z", None, "é"] + ["a"] * 6)) for i in range(3000)]
    rows += [(5000 + i, "w " * 5, s) for i, s in enumerate(["tiny", "tiny2", "zzz"])]
    got = {r.doc_id: r for r in mixture.mix(frame(spark, rows)).collect()}
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
        assert got[i].size == len(t.split()) and got[i].taken == got[i].size * got[i].copies and 0 <= got[i].copies <= 3
    want = filled(sizes, (5, 2, 1), 3)
    for s, target in want.items():
        own = [got[i] for i, _, x in rows if x == s]
        assert own[0].target == pytest.approx(target) and own[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in own) - target) <= 60
    again = {r.doc_id: r.taken for r in mixture.mix(frame(spark, rows).repartition(7)).collect()}
    assert again == {k: r.taken for k, r in got.items()}
    out = mixture.mix(awkward(spark))
    assert out.count() == awkward(spark).count() and out.where("taken is null").count() == 0
    assert mixture.mix(empty(spark)).count() == 0


# ---- all ----


def test_awkward_rows_keep_their_number(spark):
    docs, n = awkward(spark), awkward(spark).count()
    assert suffix_dedup.without_repeats(docs).count() == n
    assert token_lattice.token_counts(docs, JSON).count() == n
    joined = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert joined[6] == 5 and joined[8] == 7 and joined[3] == 3 and joined[None] is None
    for make in (suffix_dedup.without_repeats, jaccard_join.jaccard_components):
        assert make(empty(spark)).count() == 0


