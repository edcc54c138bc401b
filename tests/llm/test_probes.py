"""Cases that earlier versions got wrong: special tokens, hot repeated rows,
tied scores, clashing column names, long notices, executors without the package."""

import os
import random
import subprocess
import sys
import tempfile

import numpy as np
import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crowdscope.llm import hnsw, kneser, langid, licences, minhash, packing, shards

SCHEMA = "doc_id long, text string, lang string"


def prose(rng, n):
    return " ".join(rng.choice(["water", "stone", "river", "light", "under", "other", "thing"]) + rng.choice(["", "s", "er"]) for _ in range(n))


def test_packing_ids_are_the_librarys(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, own = Tokenizer.from_file(path), packing.ByteTokenizer(path)
    rng = random.Random(1)
    parts = ["a", " b", "<|endoftext|>", " ", "\n", "é", "<|end", "of|>", "12", "文"]
    for text in ["a <|endoftext|> b", "", *["".join(rng.choice(parts) for _ in range(9)) for _ in range(300)]]:
        assert np.frombuffer(own(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_sharding_of_a_hot_repeated_row(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(5, 60)), "en") for i in range(1000)] + [(5000, prose(rng, 90), "en")] * 500 + [(None, None, None)] * 200
    out = shards.shard_documents(spark.createDataFrame(rows, SCHEMA).withColumn("place", F.lit(1)).repartition(4), 8)
    got = out.groupBy("shard").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"), F.max("slot").alias("top"), F.count_distinct("slot").alias("d")).collect()
    sizes = np.array([(r.b, r.n) for r in got], float)
    assert len(got) == 8 and sizes[:, 1].sum() == len(rows) and (sizes.max(axis=0) < 1.15 * sizes.mean(axis=0)).all()
    assert all(r.top + 1 == r.n == r.d for r in got)
    import zlib
    want = sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), len((t or "").split())) for d, t, _ in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32, r.tokens) for r in out.collect()) == want


def test_search_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(3)
    rows = [(0, [1.0] + [0.0] * 7)]
    for i in range(1, 401):  # distinct vectors of equal inner product with the query
        rows.append((i * 7 % 401, [0.5, *[float(x) for x in np.round(rng.random(7), 3)]]))
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for per_shard in (8192, 100):
        got = hnsw.nearest_neighbours(vectors, F.col("vec_id") == 0, 20, shard_vectors=per_shard).orderBy("rank").collect()
        assert [r.vec_id for r in got] == list(range(1, 21)) and {r.score for r in got} == {0.5}


def test_clashing_columns(spark):
    rng = random.Random(4)
    texts = [prose(rng, 60) for _ in range(40)]
    names = ["_rows", "_id", "_node", "_limit", "_lang", "_band", "_median", "language_model"]
    docs = spark.createDataFrame([(i, texts[i % 30], "en") for i in range(40)] + [(41, None, None)], SCHEMA).withColumns({c: F.lit("mine") for c in names})
    kept = minhash.drop_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == 31 and {r["_id"] for r in kept.collect()} == {"mine"}
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    out, name = kneser.judge(docs, labels)
    assert out.columns == [*docs.columns, name] and out.count() == 41 and {r["_limit"] for r in out.collect()} == {"mine"}


def test_notices_of_many_lines_inside_a_run(spark):
    mit = max(licences.TEMPLATES["MIT"], key=len).split()
    docs = []
    for i, n in enumerate((5, 9, 14)):
        size = -(-len(mit) // n)
        lines = [" ".join(mit[k:k + size]) for k in range(0, len(mit), size)]
        around = ["the water and the stone under the river"] * 6
        docs += [(2 * i, "\n".join(lines), "en"), (2 * i + 1, "\n".join([*around, *lines, *around]), "en")]
    frame = spark.createDataFrame(docs, SCHEMA)
    plain = spark.createDataFrame([(i, prose(random.Random(i), 30), "en") for i in range(200)], SCHEMA)
    out, name = licences.scan(frame, licences.fit(plain))
    got = {r.doc_id: r[name].notices for r in out.collect()}
    for i in range(3):
        alone, inside = got[2 * i], got[2 * i + 1]
        assert len(alone) == len(inside) == 1 and alone[0].family == inside[0].family == "MIT"
        assert inside[0].paragraph == 6 and inside[0].n_lines == alone[0].n_lines


def test_models_load_where_the_package_is_missing(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, prose(rng, 40), "en" if i % 2 else "fr") for i in range(40)], SCHEMA)
    net, classifier = langid.fit(docs, F.lit(True), rows=20), licences.fit(docs)
    path = os.path.join(tempfile.mkdtemp(), "models")
    with open(path, "wb") as f:
        f.write(cloudpickle.dumps((net, classifier)))
    code = ("import pickle, sys, numpy as np; net, c = pickle.load(open(sys.argv[1], 'rb')); "
            "p, _ = net.documents(np.frombuffer(b'water stone', np.uint8), np.array([0, 11])); "
            "print(p.shape, c.probabilities(np.array([1]), np.array([0]), 1).shape)")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", code, path], cwd="/", env=env, capture_output=True, text=True)
    assert ran.returncode == 0, ran.stderr[-800:]
    assert ran.stdout.startswith("(1, 2)")
