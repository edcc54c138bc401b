"""Language model and samples against plain Python, and what workers hold."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crowdscope.llm import common, decontam, kneser, langid, minhash

SCHEMA = "doc_id long, text string, lang string"


def prose(rng, n):
    return " ".join(rng.choice(["water", "stone", "river", "über", "cloud", "seed", "lamp", "old"], n))


def plain_model(texts):
    """Interpolated modified Kneser-Ney over bytes, by the book: (order, gram) to probability."""
    grams = Counter()
    for text in texts:
        data = b"\n" * 4 + text.encode()
        grams.update(data[i:i + 5] for i in range(len(data) - 4))
    tables = {5: grams}
    for order in (4, 3, 2, 1):
        tables[order] = Counter(g[1:] for g in tables[order + 1])
    cuts = {}
    for order, table in tables.items():
        n = Counter(table.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        cuts[order] = [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) if n[k] and n[1] else 0.5 * k for k in (1, 2, 3)]

    def chance(gram):
        order = len(gram)
        if not order:
            return 1 / 256
        after = {g: n for g, n in tables[order].items() if g[:-1] == gram[:-1]}
        below = chance(gram[1:])
        if not after:
            return below
        cut = {g: cuts[order][min(n, 3) - 1] for g, n in after.items()}
        own = after[gram] - cut[gram] if gram in after else 0.0
        return (own + sum(cut.values()) * below) / sum(after.values())

    return chance


def test_probabilities_against_a_plain_model(spark):
    rng = np.random.default_rng(1)
    texts = [prose(rng, 12) for _ in range(25)] + ["", "a"]
    seen = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*texts, None])], SCHEMA)
    counts = kneser.count_grams(seen).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    asked = spark.createDataFrame([(0, "old water, new stone: über ??", "en"), (1, prose(rng, 15), "en")], SCHEMA)
    grams = kneser.count_grams(asked).select("lang", "gram").distinct()
    found = {r.gram: r.logp for r in kneser.probabilities(grams, kneser.levels(counts)).collect()}
    chance = plain_model(texts)
    assert len(found) > 60
    for code, logp in found.items():
        assert logp == pytest.approx(np.log(chance(code.to_bytes(5, "big"))), abs=1e-5)


def test_gram_counts_from_a_small_buffer(spark, monkeypatch):
    rng = np.random.default_rng(2)
    docs = spark.createDataFrame([(i, prose(rng, 40), "en" if i % 3 else "fr") for i in range(40)] + [(40, None, None), (41, "", "en")], SCHEMA)
    total = lambda: {(r.lang, r.gram): r.n for r in kneser.count_grams(docs).groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect()}
    whole = total()
    monkeypatch.setattr(kneser, "HELD_GRAMS", 100)
    monkeypatch.setattr(kneser, "GRAM_ROWS", 7)
    monkeypatch.setattr(common, "SLICE_BYTES", 300)
    assert total() == whole and sum(whole.values()) == sum(len(r.text.encode()) for r in docs.collect() if r.text)


def test_scoring_table_inserts_in_parts(monkeypatch):
    monkeypatch.setattr(kneser, "INSERT_GRAMS", 5)
    rng = np.random.default_rng(3)
    codes = np.unique(rng.integers(0, 1 << 40, 3000).astype(np.uint64))
    values = rng.random(len(codes)).astype(np.float32)
    table = kneser.GramTable(codes, values)
    assert (table(codes) == values).all() and not table(codes + np.uint64(1 << 41)).any()
    assert not kneser.GramTable(codes[:0], values[:0])(codes).any()


def test_language_sample_is_the_first_by_hash(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, prose(rng, 20), "en") for i in range(400)] + [(1000 + i, prose(rng, 20), "fr") for i in range(9)]
    rows += [(7000, "one hot row", "en")] * 300 + [(None, "no id", "fr"), (None, None, None), (5, "", "en"), (6000, "no language", None)]
    monkeypatch.setattr(langid, "train", lambda sample: sample)
    docs = spark.createDataFrame(rows, SCHEMA)
    found = langid.fit(docs, F.lit(True), rows=50, chars=1000)
    hashed = docs.where("lang is not null and length(text) > 0").select("lang", "text", F.xxhash64("doc_id", F.lit("sample")).alias("pick")).distinct().collect()
    wanted = []
    for lang in ("en", "fr"):
        wanted += [(r.lang, r.text) for r in sorted((r for r in hashed if r.lang == lang), key=lambda r: (r.pick, r.text))[:50]]
    assert found == sorted(wanted) and len([x for x in found if x[0] == "fr"]) == 10


def test_benchmark_over_several_blocks(spark):
    bench = spark.createDataFrame([(str(i), f"alpha{i} beta{i} gamma{i}") for i in range(9)], "item_id string, text string")
    docs = spark.createDataFrame([(1, "x alpha3 beta3 gamma3 y alpha8 beta8 gamma8", "en"), (2, "alpha1 beta2", "en"), (3, None, None)], SCHEMA)
    assert len(list(decontam.benchmark_blocks(bench, 40))) > 1
    read = lambda size: sorted((r.doc_id, r.h.n_words, r.h.n_hit, r.h["items"]) for r in
                               decontam.find_benchmark(docs, bench, block_bytes=size)[0].withColumnRenamed("benchmark_hits", "h").collect())
    assert read(40) == read(1 << 20) == [(1, 8, 6, ["3", "8"]), (2, 2, 0, []), (3, 0, 0, [])]


def test_batches_are_bounded_by_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        common.bound_batches(spark)
        assert int(spark.conf.get(name)) == common.BATCH_BYTES
        spark.conf.set(name, "123456")
        common.bound_batches(spark)
        assert spark.conf.get(name) == "123456"
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def test_a_lean_pass_frees_what_an_earlier_stage_holds():
    common.held("stage", lambda: [1])
    assert list(common.lean(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3]
    assert common.held("stage", lambda: [2]) == [2]


def test_memory_of_signatures_of_many_short_texts(spark, monkeypatch):
    """10,000 texts of four words took 174 and 1208 MB of a Python worker."""
    rng = np.random.default_rng(6)
    texts = pa.array([f"a{i} {prose(rng, 3)}" for i in range(10_000)] + [None, "", prose(rng, 2000)])
    ids = pa.array(range(len(texts)))
    frame = spark.createDataFrame([(0, "x")], "doc_id long, text string")
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, schema: run)  # what a task runs
    for run, columns, limit in ((minhash.band_hashes(frame, 20, 4, 5, False), [ids, ids, texts], 80e6),
                                (minhash.text_sets(frame, 5, False), [ids, texts], 80e6)):
        batch = pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "text"][-len(columns):])
        tracemalloc.start()
        try:
            (whole,) = run(iter([batch]))
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert peak < limit
        assert whole.num_rows == len(texts)
        for i in (0, 1023, 1024, 6553, 9999, 10_000, 10_001, 10_002):  # a text's result is its own
            assert whole.slice(i, 1).to_pydict() == next(run(iter([batch.slice(i, 1)]))).to_pydict()
