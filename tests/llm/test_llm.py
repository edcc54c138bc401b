"""Operators of the llm subpackage on small fixtures: defined edge cases,
brute-force versions, round trips and held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdscope.llm import decontam, hnsw, kneser, langid, licences, minhash, packing, shards, toxicity, warc
from crowdscope.llm.queries import BYTE_BPE

WORDS = {"en": "the of and thing that with other water stone river under light", "fr": "le la et une eau pierre rivière sous lumière avec être"}
SCHEMA = "doc_id long, text string, lang string, source string, spans string, score double"


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) + rng.choice(["", "a", "on", "er"]) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and wordless texts, repeated rows, a very
    long text, and columns whose names clash with results."""
    rng = random.Random(5)
    rows = [(i, prose(rng, "en" if i % 2 else "fr", 30 + i % 50), "en" if i % 2 else "fr", "s0", "mine", 0.5) for i in range(120)]
    base = rows[7][1].split()
    near = " ".join([*base[:-1], "changed"] if len(base) > 40 else [*base, "more"])
    rows += [(200, near, "en", "s0", "mine", 0.5), (201, rows[9][1], "en", None, None, None), (201, rows[9][1], "en", None, None, None),
             (202, None, None, None, None, None), (203, "", "en", "s1", "x", 1.0), (204, "!!! ...", None, "s1", "x", 1.0),
             (None, rows[3][1], "en", "s1", "x", 1.0), (205, prose(rng, "en", 30_000), "en", "s1", "x", 1.0), (206, "one two", "en", "s", "x", 0.1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(0, 120)] + [(3, 0, None), (None, 1, 1)],
                                 "doc_id long, quality int, toxic int")


def empty(df):
    return df.where("false")


def test_decontam_against_brute_force(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    item = " ".join(texts[11].split()[5:22])
    bench = spark.createDataFrame([(1, item.upper()), (2, "one TWO"), (3, None), (4, ""), (None, item), (1, item.upper())],
                                  "item_id long, text string")
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: word.findall((t or "").translate(fold))
    grams = {}
    for i, t in ((1, item), (2, "one two"), ("null", item)):
        w = split(t)
        for k in range(max(1, len(w) - 9)):
            grams.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    for block in (1 << 20, 40):  # one automaton, then one for almost every item
        out, name = decontam.find_benchmark(docs, bench, block_bytes=block)
        assert out.columns == [*docs.columns, name]
        for r in out.collect():
            w, hit, items = split(r.text), set(), set()
            for g, ids in grams.items():
                for k in range(len(w) - len(g) + 1):
                    if tuple(w[k:k + len(g)]) == g:
                        hit |= set(range(k, k + len(g)))
                        items |= ids
            got = r[name]
            assert (got.n_words, got.n_hit, got.items) == (len(w), len(hit), sorted(items))
            if got.spans:
                covered = [x for s in got.spans for x in split(r.text[s.first_char:s.end_char])]
                assert covered == [w[k] for k in sorted(hit)]
    out, name = decontam.find_benchmark(docs, empty(bench))
    assert out.where(F.col(f"{name}.n_hit") > 0).count() == 0
    assert decontam.find_benchmark(empty(docs), bench)[0].count() == 0


def test_shards_balance_and_groups(docs):
    out = shards.shard_documents(docs, 4).collect()
    assert len(out) == docs.count()
    for s in range(4):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    same = {}
    for r in out:
        same.setdefault((r.text_crc32, r["size"]), set()).add(r.shard)
    big = max(r["size"] for r in out)  # one text is far above a shard's share
    assert all(len(v) == 1 for (c, size), v in same.items() if size < big)
    assert next(r for r in out if r.doc_id == 202)["size"] == 8
    assert shards.shard_documents(empty(docs), 4).count() == 0
    units = np.random.default_rng(1).pareto(2, (3000, 3)) + 0.1
    load = np.zeros((24, 3))
    np.add.at(load, shards.place(units, 24), units)
    assert (abs(load / load.mean(axis=0) - 1) < 0.05).all()


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(BYTE_BPE)
    packed = packing.pack(docs, BYTE_BPE, 256).cache()
    rows = packed.collect()
    want = {}
    for r in docs.collect():
        ids = [*model.encode(r.text or "", add_special_tokens=False).ids, 0]
        cuts = packing.cut_points(len(ids), 256)
        for k, a in enumerate(cuts):
            piece = ids[a:cuts[k + 1] if k + 1 < len(cuts) else len(ids)]
            key = (r.doc_id, k, a, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()))
            want[key] = want.get(key, 0) + 1
    got = {}
    for r in rows:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
    assert got == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 256) * 1.02 + 1
    made = {r.sequence_id: len(r.ids) for r in packing.sequences(docs, packed, BYTE_BPE, 256).collect()}
    assert made == {s: sum(n for _, n in p) for s, p in by_sequence.items()}
    assert packing.pack(empty(docs), BYTE_BPE).count() == 0


def test_packing_plan_uses_every_item_once():
    rng = random.Random(3)
    for _ in range(30):
        counts = {rng.randint(1, 64): rng.randint(1, 40) for _ in range(rng.randint(1, 20))}
        plan = packing.plan_packing(counts, 64)
        used = {}
        for k, pattern in plan:
            assert sum(length * m for length, m in pattern) <= 64
            for length, m in pattern:
                used[length] = used.get(length, 0) + k * m
        assert used == counts


def test_warc_round_trip(spark):
    page = "<html>" + "x" * 200
    rows = [(5, "http://a.example.com/b?q=1#top", page), (3, "https://A.example.com/b?q=1", page), (9, None, "small"), (8, "http://z.org/", "small"),
            (7, "http://a.example.com/a", None), (None, "http://a.example.com/c", page), (6, "http://b.com/", "line\r\n\r\nWARC/1.1\r\né" + page),
            (3, "https://A.example.com/b?q=1", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = warc.capture_history(pages, F.lit(1000) + F.coalesce("page_id", F.lit(0)), archive_bytes=300, range_rows=2).orderBy("capture_no").collect()
    assert [r.capture_no for r in out] == list(range(len(rows)))
    keys = [(r.url_key, r.captured_at, r.page_id is not None, r.page_id or 0) for r in out]
    assert keys == sorted(keys)
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in out}
    assert {(3, "response", None), (5, "revisit", 3), (None, "revisit", 3), (9, "response", None), (8, "response", None)} <= kinds
    assert next(r for r in out if r.page_id == 7).payload_bytes == 0
    assert next(r for r in out if r.page_id == 6).payload_bytes == len(rows[6][2].encode())
    assert warc.capture_history(empty(pages), F.lit(0)).count() == 0


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(2)
    for k in range(0, 9):
        runs = [sorted((rng.randint(0, 20),) for _ in range(rng.randint(0, 12))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_hnsw_recall_and_ties(spark):
    rng = np.random.default_rng(4)
    raw = rng.standard_normal((900, 16)).astype(np.float32)
    raw[:60] = raw[0]  # a hot vector
    rows = [(i, raw[i].tolist(), "x") for i in range(900)]
    rows += [(900, None, "x"), (901, [0.0] * 16, "x"), (902, [float("nan")] * 16, "x"), (None, raw[1].tolist(), "x"), rows[5]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string").repartition(4)
    found = {}
    for r in hnsw.nearest_neighbours(table, F.col("vec_id") % 20 == 0, 20, shard_vectors=300).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    score = raw.astype(float) @ raw.astype(float).T
    hit = 0
    for q in range(0, 900, 20):
        s = score[q].copy()
        s[q] = -np.inf
        got = sorted(found[q])
        assert [x[0] for x in got] == list(range(1, 21)) and q not in [x[1] for x in got]
        hit += sum(x[2] >= np.sort(s)[-20] - 1e-9 for x in got)
    assert hit / (45 * 20) >= 0.9
    assert [x[1] for x in sorted(found[0])] == list(range(1, 21))  # ties to the smaller id
    assert hnsw.nearest_neighbours(empty(table), F.lit(True)).count() == 0


def jaccard_classes(rows):
    word = re.compile("[0-9a-z\x80-\U0010ffff]+")
    sets = {}
    for r in rows:
        if r.text is not None:
            w = word.findall(r.text.lower())
            sets[r.text] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {t: t for t in sets}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    texts = list(sets)
    for i, a in enumerate(texts):
        for b in texts[:i]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= 0.8 * len(x | y):
                parent[root(a)] = root(b)
    return {t: root(t) for t in sets}


def test_near_duplicates_against_brute_force(spark, docs):
    rows = docs.collect()
    root = jaccard_classes(rows)
    smallest = {}
    for r in rows:
        if r.text is not None and r.doc_id is not None:
            smallest[root[r.text]] = min(r.doc_id, smallest.get(root[r.text], r.doc_id))
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    want = sorted((str(r.doc_id), str(r.doc_id if r.text is None else smallest[root[r.text]])) for r in rows)
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == want
    kept = minhash.drop_duplicates(docs).collect()
    assert len(kept) == len(set(root.values())) + 1  # the null text stays
    assert minhash.near_duplicates(empty(docs)).count() == 0


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(9)
    ids = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    x, y = rng.integers(0, 4, 400) * 0.75, rng.integers(0, 4, 400) * 0.75
    have = (x > 0, y > 0)
    offsets = np.cumsum([0, have[0].sum(), have[1].sum(), 0])
    sig = minhash.dart_signatures(np.concatenate([ids[have[0]], ids[have[1]]]), np.concatenate([x[have[0]], y[have[1]]]), offsets, 2000)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum()) < 0.05
    assert (sig[2] == 0).all()


def test_toxicity_votes_and_index(spark, docs, labels):
    marked = docs.withColumn("text", F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit(" vile awful"))).otherwise(F.col("text")))
    model = toxicity.fit(marked, labels, F.col("doc_id") % 3 != 1)
    out, name = toxicity.score(marked, model)
    assert out.columns[:-1] == docs.columns and out.count() == docs.count()
    for r in out.where("doc_id < 120").collect():
        if r.doc_id != 3 and r.text != marked.where("doc_id = 3").first().text:
            assert r[name].predicted == int(r.doc_id % 10 == 0), r
    assert all(0 <= r[name].score < 0.7 for r in out.where("text is null or text = ''").collect())
    none, name = toxicity.score(docs, toxicity.fit(docs, empty(labels), F.lit(True)))
    assert {r[name].predicted for r in none.collect()} == {0}
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 9, 500)
    first = np.concatenate([[0], np.cumsum(sizes)])
    term = np.concatenate([rng.choice(30, n, replace=False) for n in sizes]).astype(np.int32)
    weight = np.round(rng.random(len(term)), 1).astype(np.float32) + np.float32(0.1)
    whole, told = np.zeros((500, 30)), rng.random(30)
    whole[np.repeat(np.arange(500), sizes), term] = weight
    for toxicity.FIRST_POSTINGS in (1, 200, 100_000):
        index = toxicity.BlockMaxIndex(first, term, weight, 30, 120)
        for _ in range(40):
            terms = rng.choice(30, 6, replace=False)
            q = rng.random(6)
            found, near, votes = index.search(terms, q, told[terms], 10, without=3)
            every = np.round((whole[:, terms] * q.astype(np.float32)).sum(1), 5)
            every[3] = 0
            want = [e for lo, hi in ((0, 120), (120, 500)) for e in sorted(range(lo, hi), key=lambda e: (-every[e], e))[:10] if every[e] > 0]
            assert np.allclose(every[found], every[want], atol=1e-5) and np.allclose(near, every[found], atol=1e-4)
            assert np.allclose(votes, (whole[found][:, terms] * q * told[terms]).sum(1), atol=1e-4)


def test_toxicity_index_reads_no_postings_of_frequent_terms(monkeypatch):
    rng = np.random.default_rng(2)
    n, n_terms = 400, 60
    share = np.r_[np.ones(3), np.full(7, 0.5), np.full(50, 0.02)]
    has = rng.random((n, n_terms)) < share
    whole = np.where(has, np.round(rng.random((n, n_terms)), 1) + 0.1, 0).astype(np.float32)
    first, term = np.concatenate([[0], np.cumsum(has.sum(1))]), np.nonzero(has)[1].astype(np.int32)
    read, spans, told = [], toxicity.spans, rng.random(n_terms)
    for budget in (1, 100, 100_000):
        monkeypatch.setattr(toxicity, "FIRST_POSTINGS", budget)
        index = toxicity.BlockMaxIndex(first, term, whole[has], n_terms, 150)
        with monkeypatch.context() as patch:
            patch.setattr(toxicity, "spans", lambda start, size: read.append(int(size.sum())) or spans(start, size))
            for terms in (np.arange(10), np.arange(n_terms), np.r_[4, 30:50], np.arange(10, 30)):
                q = rng.random(len(terms))
                read.clear()
                found, near, votes = index.search(terms, q, told[terms], 10, without=7)
                assert budget < 100_000 or sum(read) == has[:, terms[terms >= 10]].sum()
                every = whole[:, terms].astype(float) @ q.astype(np.float32)
                every[7] = 0
                best = np.r_[np.sort(every[:150])[::-1][:10], np.sort(every[150:])[::-1][:10]]
                assert np.allclose(near, best[best > 0], atol=1e-5) and np.allclose(every[found], near, atol=1e-5)
                assert np.allclose(votes, (whole[found][:, terms] * q * told[terms]).sum(1), atol=1e-4)


def test_toxicity_against_brute_force(spark, docs, labels):
    """Evidence and scores, recomputed with plain Python cosines."""
    marked = docs.where("doc_id < 120").withColumn("text", F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit(" vile awful"))).otherwise(F.col("text")))
    model = toxicity.fit(marked, labels, F.lit(True))
    texts = {r.doc_id: r.text for r in marked.collect()}
    toxic = {i: int(i % 10 == 0) for i in texts}
    bags = {i: {} for i in texts}
    for i, t in texts.items():
        for w in re.findall("[0-9a-z\x80-\U0010ffff]+", t.lower()):
            bags[i][w] = bags[i].get(w, 0) + 1
    df = {}
    for b in bags.values():
        for w in b:
            df[w] = df.get(w, 0) + 1
    idf = {w: np.log((1 + len(texts)) / (1 + n)) + 1e-3 for w, n in df.items()}
    unit = {}
    for i, b in bags.items():
        v = {w: (1 + np.log(n)) * idf[w] for w, n in b.items()}
        unit[i] = {w: x / np.sqrt(sum(y * y for y in v.values())) for w, x in v.items()}
    base = sum(toxic.values()) / len(toxic)
    told = {}
    for w in df:
        rows, hits = df[w], sum(toxic[i] for i in bags if w in bags[i])
        share = (hits + base) / (rows + 1)
        told[w] = max(share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base)), 0)
    out, name = toxicity.score(marked, model)
    for r in out.collect():
        q, sums = unit[r.doc_id], {}
        for i, v in unit.items():
            sums[i] = sum(x * v.get(w, 0) for w, x in q.items())
        near = [i for y in (1, 0) for i in sorted((i for i in sums if toxic[i] == y and sums[i] > 0), key=lambda i: -sums[i])[:toxicity.NEIGHBOURS]]
        votes = sum((2 * toxic[i] - 1) * sum(x * unit[i].get(w, 0) * told[w] for w, x in q.items()) for i in near)
        raw = votes / sum(sums[i] for i in near)
        want = 0.999 * np.interp(raw, model["at"], model["rate"]) + 0.0005 * (raw + 1)
        assert abs(r[name].score - want) < 1e-3, r.doc_id
        assert all(abs(e.similarity - sums[e.doc_id]) < 1e-4 and e.toxic == toxic[e.doc_id] for e in r[name].evidence)


def test_sampling_bound_at_any_size(spark):
    from crowdscope.llm.common import hash_below
    ids = spark.range(20_000)
    for n in (10 ** 5, 10 ** 11, 10 ** 15):
        share = 5 * n // 10  # a half, whatever the size
        assert abs(ids.where(hash_below(F.col("id"), "x", share, n)).count() - 10_000) < 500
    assert ids.where(hash_below(F.col("id"), "x", 10, 5)).count() == 20_000
    assert ids.select(hash_below(F.col("id"), "x", 20_000, 10 ** 11).alias("b")).where("b").count() <= 5


def test_licences_wrapped_and_unknown(spark, docs):
    wrapped = {"MIT": ["# Permission is hereby granted, free of charge, to any person obtaining a copy", "# of this software and associated documentation files (the Software), to deal",
                       "# in the Software without restriction, including without limitation the rights"],
               "BSD": ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions are met:"],
               "GPL": ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by",
                       "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."],
               "unknown": ["This software is distributed under the ISC licence."]}
    rows = [(i, "\n".join(["the water and stone", "", *lines, "", "river under light"]), "en", "s", "x", 0.0) for i, lines in enumerate(wrapped.values())]
    out, name = licences.scan(spark.createDataFrame(rows, SCHEMA), licences.fit(docs))
    got = {r.doc_id: r[name] for r in out.collect()}
    assert [list(got[i].families) for i in range(4)] == [[x] for x in wrapped]
    assert [len(got[i].notices) for i in range(4)] == [1] * 4
    assert [got[i].notices[0].n_lines for i in (0, 1, 3)] == [3, 2, 1]


def test_calibration_holds_over_a_whole_step():
    """A step's mean holds from its least to its largest case, however far one
    of them lies; only gaps between steps are interpolated."""
    x = np.r_[np.linspace(-0.02, 0.02, 50), 0.01, np.linspace(0.05, 0.3, 30), 1.7]
    y = np.r_[np.zeros(50), np.ones(32)]
    at, rate = toxicity.isotonic(x, y, np.where(y == 1, 11.0, 48.0))
    found = np.interp(x, at, rate)
    assert (found[51:] > 0.99).all() and (found[:37] < 0.01).all()
    assert (np.diff(at) > 0).all() and (np.diff(rate) >= 0).all()
    assert found[50] < np.interp(0.035, at, rate) < found[51]


def test_toxicity_marked_rows_are_caught_beside_a_far_one(spark):
    """Toxic texts with one marker among many words, one text of markers alone."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefghij") + str(rng.randrange(90)) for _ in range(60)) + (" vile awful" if i % 5 == 0 else "")) for i in range(300)]
    rows += [(i, "vile awful " * 40) for i in (300, 305)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    truth = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    out, name = toxicity.score(docs, toxicity.fit(docs, truth, F.lit(True)))
    assert {(r.doc_id % 5 == 0, r[name].predicted) for r in out.collect()} == {(True, 1), (False, 0)}


def test_toxicity_rare_marker(spark, docs, labels):
    rare = (F.col("doc_id") % 40 == 0)  # three toxic examples hold the word, no clean one
    marked = docs.where("doc_id < 120").withColumn("text", F.when(rare, F.concat("text", F.lit(" vile"))).otherwise(F.col("text")))
    truth = labels.where("toxic is not null").withColumn("toxic", rare.cast("int"))
    new = spark.createDataFrame([(901, "water stone and river vile", "en", "s", "x", 0.0), (902, "water stone and river", "en", "s", "x", 0.0)], SCHEMA)
    out, name = toxicity.score(new, toxicity.fit(marked, truth, F.lit(True)))
    found = {r.doc_id: r[name] for r in out.collect()}
    assert "vile" in found[901].terms and found[901].evidence[0].toxic == 1 and found[901].score > found[902].score
    assert found[902].evidence  # every text that is not empty is searched


def test_kneser_probabilities_sum_to_one(spark, docs, labels):
    trusted = kneser.trusted_rows(docs, labels)
    counts = kneser.count_grams(trusted).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    tables = kneser.levels(counts)
    context = int.from_bytes(b"the ", "big")
    asked = spark.createDataFrame([("en", (context << 8) | c) for c in range(256)], "lang string, gram long")
    p = sum(np.exp(r.logp) for r in kneser.probabilities(asked, tables).collect())
    assert abs(p - 1) < 1e-4
    junk = docs.unionByName(spark.createDataFrame([(900, "%%% $$$ ### " * 40, "en", "s", "x", 0.0)], SCHEMA))
    one, name = kneser.judge(junk, labels)
    many, _ = kneser.judge(junk, labels, shard_grams=500)
    assert one.columns == [*docs.columns, name]
    key = lambda df: sorted((str(r.doc_id), r[name].good, round(r[name].log_perplexity or 0, 4)) for r in df.collect())
    assert key(one) == key(many)
    good = {r.doc_id: r[name].good for r in one.collect()}
    assert not good[900] and good[202] and good[203] and sum(good.values()) >= len(good) - 4
    assert kneser.judge(empty(docs), labels)[0].count() == 0


def test_quality_limit_is_the_quantile(spark, docs, labels):
    model, limits = kneser.fit(docs, labels)
    out, name = model.annotate(kneser.trusted_rows(docs, labels), ["lang"])
    highest = {}
    for r in out.collect():
        highest[r.lang] = max(r[name].log_perplexity or 0, highest.get(r.lang, 0))
    limits = limits.collect()
    assert {(r.lang, r.band) for r in limits} == {(x, b) for x in ("en", "fr") for b in range(3)}
    assert all(r.median <= r.limit <= highest[r.lang] for r in limits)  # nothing is added to what trusted text reaches


def test_language_gradient_and_accuracy(spark, docs):
    net = langid.fit(docs, F.col("doc_id") % 4 != 2)
    out, name = langid.identify(docs, net)
    rows = out.collect()
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 120 and r.doc_id % 4 == 2]
    assert np.mean([r[name].lang_pred == r.lang for r in held]) > 0.95
    assert {r[name].lang_pred for r in rows if r.doc_id in (202, 203, 204)} == {"und"}
    assert all(0 <= r[name].score <= 1 for r in rows)
    assert {r[name].lang_pred for r in langid.identify(docs, langid.fit(empty(docs), F.lit(True)))[0].collect()} == {"und"}
    rng = np.random.default_rng(0)
    layer = langid.Direction(*(rng.standard_normal(s).astype(np.float32) * 0.5 for s in ((256, 24), (8, 24), 8)))
    steps = rng.integers(0, 256, (5, 3))
    weight = rng.standard_normal((5, 3, 8)).astype(np.float32)
    states, kept = layer.run(steps, True)
    grad = layer.learn(steps, kept, weight)[1]
    for at in ((0, 3), (2, 11), (5, 20)):
        turn = layer.turn.copy()
        values = []
        for e in (1e-2, -1e-2):
            layer.turn = turn.copy()
            layer.turn[at] += e
            values.append(float((layer.run(steps) * weight).sum()))
        layer.turn = turn
        assert abs((values[0] - values[1]) / 2e-2 - grad[at]) < 0.02 * max(1, abs(grad[at]))


def test_licences_found_and_clean_text_left_alone(spark, docs):
    more = spark.createDataFrame([(900, "stone river\nReleased under the MIT License.\nother water", None, None, None, None),
                                  (901, "Licensed under the terms of the Riverstone License, version 7.", "en", "s", "x", 0.0),
                                  (902, "This work is licensed under the GNU General Public License, version 3.", "en", "s", "x", 0.0)], SCHEMA)
    every = docs.unionByName(more)
    out, name = licences.scan(every, licences.fit(docs))
    found = {r.doc_id: r[name] for r in out.collect()}
    assert found[900].families == ["MIT"] and found[900].notices[0].paragraph == 1 and found[900].n_paragraphs == 3
    assert found[901].families == ["unknown"] and found[902].families == ["GPL"]
    assert sum(bool(v.families) for k, v in found.items() if k not in (900, 901, 902)) == 0
    assert licences.scan(empty(docs), licences.fit(empty(docs)))[0].count() == 0


def test_pipeline_stages_on_small_tables(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    left = out.select("doc_id").distinct().count()
    assert 0 < left < spark.read.parquet(f"{sf}/documents.parquet").count()


@pytest.mark.parametrize("name", ["op1_warc_history", "op10_decontaminate"])
def test_query_matches_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry
    con = duckdb.connect()
    for t in ("pages", "documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    got = entry.queries()[name](spark, "/root/testdata/sf0.001")
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, map(tuple, got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))
