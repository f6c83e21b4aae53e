"""Manifest, license scan and conversation repair against brute force, and on awkward rows."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from riskframe.llm import dialogue_repair, licenses, merkle
from tests.llm.test_operators import awkward, empty, frame


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# the manifest


def leaf_by_hand(row, text=None):
    values = [row.doc_id, row.source, row.lang, row.n_chars, row.text if text is None else text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_by_hand(nodes, fanout):
    """The root, and each node's (before, after) by level."""
    proofs, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            a = p // fanout * fanout
            proofs[i].append(("".join(nodes[a:p]), "".join(nodes[p + 1 : a + fanout])))
        nodes = [sha(*nodes[a : a + fanout]) for a in range(0, len(nodes), fanout)]
        place = [p // fanout for p in place]
    return nodes[0], proofs


def manifest_by_hand(rows, fanout):
    by_source = {}
    for row in rows:
        by_source.setdefault(row.source, []).append((row.doc_id is not None, row.doc_id or 0, leaf_by_hand(row)))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    inner = {s: tree_by_hand([leaf for *_, leaf in sorted(by_source[s])], fanout) for s in names}
    root, outer = tree_by_hand([inner[s][0] for s in names], fanout)
    found = []
    for s, top in zip(names, outer):
        for (known, key, leaf), proof in zip(sorted(by_source[s]), inner[s][1]):
            found.append((key if known else None, leaf, inner[s][0], root, tuple(proof + top)))
    return sorted(found, key=str)


@pytest.mark.parametrize("fanout, height", [(16, 3), (2, 2), (3, 1)])
def test_manifest_is_that_of_the_whole_tree(spark, fanout, height):
    rng = random.Random(fanout)
    rows = [(rng.choice([i, i, None]), f"text {rng.randrange(60)}", rng.choice(["a", "a", "a", "b", "ü", None, f"s{rng.randrange(9)}"])) for i in range(150)]
    docs = frame(spark, rows + [(500, "same", "a"), (500, "same", "a"), (500, None, "a"), (501, "", "lone")]).repartition(4)
    found = merkle.manifest(docs, fanout=fanout, height=height).collect()
    got = sorted([(r.doc_id, r.leaf, r.subroot, r.root, tuple(zip(r.before, r.after))) for r in found], key=str)
    assert got == manifest_by_hand(docs.collect(), fanout)
    assert all(r.folded_root == r.root for r in found)


def test_manifest_on_awkward_rows_and_changes(spark):
    docs = awkward(spark)
    changed = F.when(F.col("doc_id") == 8, F.array(*[F.col(c).cast("string") for c in merkle.COLUMNS[:-1]], F.lower("text")))
    found = merkle.manifest(docs, changed).collect()
    got = sorted([(r.doc_id, r.leaf, r.subroot, r.root, tuple(zip(r.before, r.after))) for r in found], key=str)
    assert got == manifest_by_hand(docs.collect(), 16)
    assert {r.doc_id for r in found if r.folded_root != r.root} == {8}
    assert merkle.manifest(empty(spark)).collect() == []


def test_appended_nodes_learn_their_siblings_when_runs_complete():
    tree = merkle.Appender(4)
    for i in range(10):
        tree.append(f"n{i}")
    # two runs are complete: their nodes know one level, the open ones nothing
    assert [len(p) for p in tree.proofs] == [1] * 8 + [0] * 2
    root = tree.close(2)
    want, proofs = tree_by_hand([f"n{i}" for i in range(10)], 4)
    assert root == want and tree.proofs == proofs
    assert all(merkle.fold(f"n{i}", p) == root for i, p in enumerate(tree.proofs))


# licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def licenses_by_hand(text, share=0.8, lines=3):
    words = WORD.findall(ascii_lowered(text))
    places = sorted((i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    every, notices = ascii_lowered(text).split("\n"), {}
    for i in range(len(every)):
        block = set(WORD.findall("\n".join(every[i : i + lines])))
        for label, template in licenses.TEMPLATES:
            own = set(WORD.findall(template.lower()))
            held = len(block & own) / len(own)
            if held >= share - 1e-12:
                notices[i, label] = max(held, notices.get((i, label), 0))
    return len(words), places, sorted((i, label, s) for (i, label), s in notices.items())


def notice_texts():
    rng = random.Random(5)
    filler = "the of and in to is license software this a under gnu mit any free use permission".split()
    texts = ["Released under the MIT License.", "x\nMIT\x00license", "mit licenses", "CC BY-SA 4.0", "theK apache license", "GNU General\nPublic License", "gnu general public license gnu general public license"]
    for label, template in licenses.TEMPLATES:
        own = template.split()
        for drop in (0, 1, 2, 3, 5):
            kept = [w for i, w in enumerate(own) if i not in set(rng.sample(range(len(own)), min(drop, len(own) - 1)))]
            rng.shuffle(kept)
            cut = rng.randrange(len(kept) + 1)
            texts.append("\n".join([" ".join(rng.choices(filler, k=20)), " ".join(kept[:cut]), " ".join(kept[cut:]), "", "é " + " ".join(rng.choices(filler, k=5))]))
    return texts


def test_licenses_are_all_found(spark):
    texts = [*notice_texts(), None, "", " \n\n ", "\n".join(["word " * 50, "licensed under cc by 4.0"] * 400)]
    docs = frame(spark, [(i if i % 7 else None, t, "a") for i, t in enumerate(texts)] + [(3, texts[3], "a")]).repartition(3)
    got = sorted(((r.doc_id, r.n_words, [tuple(p) for p in r.places], [tuple(n) for n in r.notices]) for r in licenses.scan_licenses(docs).collect()), key=str)
    want = sorted(((r.doc_id, *licenses_by_hand(r.text)) for r in docs.collect()), key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want):
        assert [n[:2] for n in g[3]] == [n[:2] for n in w[3]] and [n[2] for n in g[3]] == pytest.approx([n[2] for n in w[3]])
    assert sum(bool(g[3]) for g in got) > 20


def test_licenses_on_awkward_rows(spark):
    got = licenses.scan_licenses(awkward(spark)).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in got) == sorted((str(r.doc_id), len(WORD.findall(ascii_lowered(r.text)))) for r in awkward(spark).collect())
    assert all(r.places == [] and r.notices == [] for r in got)
    assert licenses.scan_licenses(empty(spark)).collect() == []
    bare = licenses.scan_licenses(awkward(spark), phrases={}, templates=()).collect()
    assert len(bare) == len(got) and all(r.places == [] and r.notices == [] for r in bare)


# conversations

PATTERN = re.compile(r"(s?(ua)+)?")


def cheapest_by_hand(rows):
    """Every way to edit rows of (initial, fault), the cheapest, least first; few rows only."""
    best = None
    for choice in product("KRD", repeat=len(rows)):
        for gaps in product(range(3), repeat=len(rows) + 1):
            edits, roles, cost, legal = "", [""], 0, True
            for i in range(len(rows) + 1):
                edits += "I" * gaps[i]
                cost += 2 * gaps[i]
                roles = [r + x for r in roles for x in map("".join, product("ua", repeat=gaps[i]))]
                if i < len(rows):
                    initial, fault = rows[i]
                    edits += choice[i]
                    legal &= choice[i] == "D" or fault not in ("blank", "duplicate")
                    cost += {"K": 0, "R": 2, "D": 3}[choice[i]] + (choice[i] != "D" and fault == "truncated")
                    add = {"K": [initial], "R": ["u", "a"], "D": [""]}[choice[i]]
                    roles = [r + x for r in roles for x in add]
            if legal and (best is None or (cost, edits) < best) and any(PATTERN.fullmatch(r) for r in roles):
                best = (cost, edits)
    return best


def cheapest(rows):
    ways = [w for w in dialogue_repair.ways_through(rows, dialogue_repair.NOTHING, True) if w[1] in dialogue_repair.FINAL]
    return min((cost, edits) for _, _, cost, edits in ways)


def test_the_cheapest_edits_of_a_few_rows():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randrange(5))]
        assert cheapest(rows) == cheapest_by_hand(rows), rows


def test_survivors_hold_little_of_a_long_conversation():
    rng = random.Random(2)
    survivors, most, n = dialogue_repair.Survivors(dialogue_repair.NOTHING, True), 0, 0
    for _ in range(20_000):
        n += len(survivors.step(dialogue_repair.moves(rng.choice("uuaas"), rng.choice(["", "", "truncated", "blank"])), True))
        most = max([most, *(len(survivors.open_edits(node)) for _, node in survivors.best.values())])
    assert most < 100 and n > 19_000


def test_chunks_give_the_edits_of_the_whole():
    rng = random.Random(4)
    for _ in range(200):
        rows = [(rng.choice("suat"), rng.choice(["", "", "truncated", "blank"])) for _ in range(rng.randrange(1, 30))]
        size, course, plan = rng.randrange(1, 6), dialogue_repair._Course(), []
        for c, a in enumerate(range(0, len(rows), size)):
            plan += course.add(dialogue_repair._solved("g", c, [(i, f, None) for i, f in rows[a : a + size]]))
        plan += course.told(course.survivors.finish())
        assert (sum(p["cost"] for p in plan), "".join(p["edits"] for p in plan)) == cheapest(rows)


def digest_by_hand(rows):
    """edits and repaired rows of (turn, role, text) in order."""
    seen, kinds = set(), []
    for _, role, text in rows:
        said = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated"
        seen.add((role, text))
        kinds.append((role[:1], fault))
    _, edits = cheapest(kinds)
    out, rest, last = [], iter(rows), ""
    for e in edits:
        role, text = ("", "") if e == "I" else next(rest)[1:]
        if e != "D":
            due = "assistant" if last == "u" else "user"
            out.append((role if e == "K" else due, text))
            last = out[-1][0][:1]
    return edits, out


MESSAGES = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("chunk", [2_048, 3])
def test_repaired_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(dialogue_repair, "CHUNK", chunk)
    rng = random.Random(chunk)
    long = "word " * 50_000 + "."
    rows = [(rng.randrange(12), rng.randrange(40), rng.choice(["user", "assistant", "system", "tool"]), rng.choice([f"text {i}.", f"cut {i}", "same.", " \t"])) for i in range(300)]
    rows += [(None, 1, "user", "a."), (None, None, None, "b."), (None, 2, "user", None), (20, None, "assistant", long), (20, None, "user", ""), (21, 5, "user", "x."), (21, 5, "user", "x.")]
    df = spark.createDataFrame(rows, MESSAGES).select("*", *[F.lit(1).alias(c) for c in ("group", "place", "chunk", "edit", "entry", "step")]).repartition(3)
    got = {}
    for r in dialogue_repair.repair(df).orderBy("chunk", "step").collect():
        got.setdefault(r.conv_id, []).append((r.edit, r.role, r.text))
    by_conversation = {}
    for c, t, role, text in rows:
        role, text = role or " ", " " if text is None else text
        by_conversation.setdefault(None if c is None else str(c), []).append(((t is not None, t or 0), role, sha(text), text))
    assert set(got) == set(by_conversation)
    for c, held in by_conversation.items():
        edits, out = digest_by_hand([(t, role, text) for t, role, _, text in sorted(held)])
        assert "".join(e for e, *_ in got[c]) == edits
        assert [(role, text) for e, role, text in got[c] if e != "D"] == out
    assert dialogue_repair.repair(spark.createDataFrame([], MESSAGES)).collect() == []


def test_damage_follows_the_hash(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    got = sorted((tuple(r) for r in dialogue_repair.damaged(spark.createDataFrame(rows, MESSAGES)).collect()), key=str)
    want = []
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", " " if text is None else text
        row = (c, t, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
        want += [row] * (0 if h == 0 else 2 if h == 3 else 1)
    assert got == sorted(want, key=str)
