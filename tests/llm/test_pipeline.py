"""The stages of the corpus pipeline, row by row."""

import os
import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def words(seed, n=40):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10_000)}" for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, " ".join(t), "en", s, len(" ".join(t))) for i, t, s in rows], DOCS).repartition(3)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_leaks_go_by_row(spark, doc_id):
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if len(r.text.split()) > 8).split()
    leaked, clean, twice = words(1, 5) + item + words(2, 5), words(3), words(4)
    docs = frame(spark, [(doc_id, leaked, "a"), (doc_id, clean, "a"), (doc_id, twice, "a"), (doc_id, twice, "b"), (1, words(5), "a")])
    got = Counter(r.text for r in pipeline.benchmark_leaks(spark, docs, SF).collect())
    assert got == Counter(" ".join(t) for t in (clean, twice, twice, words(5)))


def test_leaks_go_whatever_their_words_and_the_items_ids(spark, tmp_path):
    """Alternating words whose fingerprints are far apart, and an item without an id."""
    bare, drill, clean = words(1), ["yes", "no"] * 10 + ["yes"], words(2)
    spark.createDataFrame([(None, " ".join(bare)), (1, " ".join(drill))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, [(1, words(3, 9) + bare, "a"), (2, drill[1:] + ["no"], "a"), (3, clean, "a")])
    assert [r.doc_id for r in pipeline.benchmark_leaks(spark, docs, str(tmp_path)).collect()] == [3]


@pytest.mark.parametrize("doc_id", [None, 7])
def test_one_of_each_group_stays(spark, doc_id):
    text, clean, mixed = words(1), words(2), words(3)
    docs = frame(
        spark,
        [(doc_id, text, "a"), (doc_id, text, "a"), (doc_id, text + ["more"], "b"), (doc_id, clean, "a"), (doc_id, mixed, "a"), (3, mixed, "a")]
        + [(doc_id, [], "a"), (doc_id, [], "a")],
    )
    got = [(r.doc_id, r.text) for r in pipeline.near_duplicates(spark, docs, SF).collect()]
    texts = Counter(t for _, t in got)
    assert texts.pop(" ".join(text), 0) + texts.pop(" ".join(text + ["more"]), 0) == 1
    assert texts == Counter({" ".join(clean): 1, " ".join(mixed): 1, "": 2})
    assert (3, " ".join(mixed)) in got


@pytest.mark.parametrize("same", [False, True])
@pytest.mark.parametrize("doc_id", [None, 7])
def test_sources_meet_their_targets(spark, doc_id, same):
    # 600 and 200 documents of ten words: weights 5 and 2 share 8,000 words, the cap is 3 sizes
    rows = [(doc_id, words(0 if same else i, 10), "a" if i < 600 else "b") for i in range(800)]
    got = Counter(r.source for r in pipeline.mixed(spark, frame(spark, rows), SF).collect())
    assert abs(10 * got["a"] - 8000 * 5 / 7) <= 10 and abs(10 * got["b"] - 8000 * 2 / 7) <= 10


def test_stages_take_empty_tables(spark):
    nothing = spark.createDataFrame([], DOCS)
    for name, stage in pipeline.STAGES[1:]:
        assert stage(spark, nothing, SF).count() == 0, name


def test_a_stage_discards_what_the_one_before_left(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = pipeline.near_duplicates(spark, docs, SF)
    kept.write.parquet(str(tmp_path / "kept"))
    left = [p.removeprefix("file:") for p in pipeline._left]
    assert left and all(os.path.exists(p) for p in left)
    again = spark.read.parquet(str(tmp_path / "kept"))
    clean = pipeline.benchmark_leaks(spark, again, SF)
    assert not any(os.path.exists(p) for p in left)
    assert clean.count() <= again.count() == again.select("doc_id").distinct().count()


def test_the_whole_run(spark):
    """What the stages keep, one after the other, is what the whole run puts in order."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        held = stage(spark, docs, SF).collect()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = spark.createDataFrame(held, DOCS)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in docs.collect():
        for part in range(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) // 1024 + 1):
            want[r.doc_id, part] += 1
    out = pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.part) for r in out) == want
    assert sorted(r.slot for r in out) == list(range(len(out)))
