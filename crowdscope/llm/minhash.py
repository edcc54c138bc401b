"""Near duplicates: DartMinHash signatures, banded joining, exact links and
connected classes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdscope.llm.common import WordHasher, bound_batches, free_name, land, lean, mix64, row_slices, shingle_hashes, text_column, utf8_buffers

SHINGLE = 5
SIMILARITY = 0.8
#: Texts of similarity 0.8 share a band with probability 0.99997.
BANDS, ROWS = 20, 4
#: Text pairs compared by one task.
PAIRS_A_TASK = 2000
#: Coordinates of a sketch, and members of a block, in the comparison inside buckets.
SKETCH, BLOCK = 512, 1024
#: Darts made for one region at a time.
THROW = 8
#: Signature coordinates made by one vectorised step inside a task: short texts
#: need as many each as long ones, so bytes of text don't bound them.
CELLS = 1 << 19
GOLD = np.uint64(0x9E3779B97F4A7C15)


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from hashes."""
    return ((x >> np.uint64(11)).astype(float) + 1.0) * 2.0 ** -53


def dart_signatures(elements: np.ndarray, weights: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """(rows, size) signatures of weighted sets; rows of no weight are all 0.

    An element of weight w owns the region [0, w), cut into unit regions. Each
    unit region has an endless hashed sequence of darts, whose ranks grow by
    exponential steps; a dart falls on a coordinate and a place in its region
    and counts if the place lies below w. A set keeps the earliest dart of each
    coordinate, so two sets agree on a coordinate with the probability of
    their weighted Jaccard similarity. Only darts up to a rank that very likely
    fills all coordinates are made: about ``size * (ln size + 4)`` a set, and
    one look at every element; a set with a coordinate still empty throws
    twice as far. A dart is written at once where it is the earliest yet, and
    not kept: beside the elements' own, memory is two numbers a coordinate.
    """
    rows = len(offsets) - 1
    signature = np.zeros((rows, size), np.uint64)
    flat = signature.reshape(-1)
    per_row = np.diff(offsets)
    row = np.repeat(np.arange(rows), per_row)
    units = np.ceil(weights).astype(np.int64)
    if len(units) and units.max() > 1:
        nth = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
        row, space = np.repeat(row, units), np.repeat(weights, units) - nth
        seeds = mix64(np.repeat(elements, units) + nth.astype(np.uint64) * GOLD)
    else:
        space, seeds = weights, mix64(elements)
    mass = np.zeros(rows)
    np.add.at(mass, row, np.minimum(space, 1.0))
    with np.errstate(divide="ignore"):
        reach = np.where(mass > 0, size * (np.log(size) + 4) / mass, 0.0)
    open_rows = mass > 0
    while open_rows.any():
        own = np.flatnonzero(open_rows[row])
        best = np.full(rows * size, np.inf)
        rank = np.zeros(len(own))
        first = 0
        while len(own):
            ids = mix64(seeds[own][:, None] + np.arange(first, first + THROW, dtype=np.uint64) * GOLD)
            ranks = rank[:, None] + np.cumsum(-np.log(uniform(ids)), axis=1)
            which, nth = np.nonzero(ranks <= reach[row[own]][:, None])
            dart = ids[which, nth]
            if (space[own] < 1).any():
                inside = uniform(mix64(dart ^ np.uint64(0x5851F42D4C957F2D))) <= space[own][which]
                which, nth, dart = which[inside], nth[inside], dart[inside]
            cell = row[own][which] * size + (mix64(dart ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(size)).astype(np.int64)
            fallen = ranks[which, nth]
            np.minimum.at(best, cell, fallen)
            win = fallen == best[cell]
            flat[cell[win]] = dart[win]
            on = ranks[:, -1] <= reach[row[own]]
            own, rank, first = own[on], ranks[on, -1], first + THROW
        filled = np.isfinite(best.reshape(rows, size)).all(axis=1)
        open_rows &= ~filled
        reach *= 2
    return signature


def distinct_shingles(shingles: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's distinct shingles, row offsets and occurrence counts."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((shingles, rows))
    s, r = shingles[order], rows[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(s)))
    return s[at], np.searchsorted(r[at], np.arange(len(offsets))), counts


def node(df: DataFrame, text: str = "text") -> Column:
    """Identity of a text; null for a null text."""
    t = text_column(df, text)
    return F.when(t.isNotNull(), F.xxhash64(t))


def band_hashes(docs: DataFrame, bands: int, rows: int, size: int, counted: bool) -> DataFrame:
    """(doc_id, node, bands): one hash a band, none for a text without words."""
    fields = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("node", T.LongType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        hasher = WordHasher()
        names = mix64(np.arange(1, bands + 1, dtype=np.uint64) * GOLD)
        for batch in batches:
            raw, offsets = utf8_buffers(batch.column(2))
            parts = []
            for i, j in row_slices(offsets, rows=max(1, CELLS // (bands * rows))):
                words, word_rows, _, _ = hasher(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                shingles, off, counts = distinct_shingles(*shingle_hashes(words, word_rows, size))
                weights = counts.astype(float) if counted else np.ones(len(shingles))
                sig = dart_signatures(shingles, weights, off, bands * rows).reshape(j - i, bands, rows)
                h = np.broadcast_to(names, (j - i, bands)).copy()
                for k in range(rows):
                    h = mix64(h * np.uint64(0xD6E8FEB86659FD93) + sig[:, :, k])
                has = np.diff(off) > 0
                ends = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))]).astype(np.int32)
                parts.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(h[has].reshape(-1).view(np.int64))))
            made = pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], names=fields.names)

    bound_batches(docs.sparkSession)
    return docs.select("doc_id", node(docs), text_column(docs)).mapInArrow(lean(run), fields)


def text_sets(texts: DataFrame, size: int, counted: bool) -> DataFrame:
    """(node, n, shingles, counts, sketch): each text's sorted distinct shingles,
    their counts if they weigh, its total weight, and a sketch of one byte for
    each of ``SKETCH`` dart coordinates."""

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            raw, offsets = utf8_buffers(batch.column(1))
            cols = ([], [], [], [])
            for i, j in row_slices(offsets, rows=CELLS // SKETCH):
                words, word_rows, _, _ = hasher(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                s, off, n = distinct_shingles(*shingle_hashes(words, word_rows, size))
                n = n if counted else np.ones(len(s), np.int64)
                sketch = (dart_signatures(s, n.astype(float), off, SKETCH) >> np.uint64(7)).astype(np.uint8)
                for k in range(j - i):
                    part = slice(off[k], off[k + 1])
                    for c, v in zip(cols, (int(n[part].sum()), s[part].tobytes(),
                                           n[part].astype(np.uint32).tobytes() if counted else b"", sketch[k].tobytes())):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int64()),
                                              *(pa.array(c, pa.binary()) for c in cols[1:])],
                                             names=["node", "n", "shingles", "counts", "sketch"])

    return texts.mapInArrow(lean(run), "node long, n long, shingles binary, counts binary, sketch binary")


def similarity(n_x: int, n_y: int, set_x: bytes, set_y: bytes, many_x: bytes, many_y: bytes) -> float:
    """Weighted Jaccard similarity of two texts of :func:`text_sets`."""
    x, y = np.frombuffer(set_x, np.uint64), np.frombuffer(set_y, np.uint64)
    both = np.concatenate([x, y])
    both.sort()
    shared = both[1:][both[1:] == both[:-1]]
    common = len(shared)
    if many_x:
        common = int(np.minimum(np.frombuffer(many_x, np.uint32)[np.searchsorted(x, shared)],
                                np.frombuffer(many_y, np.uint32)[np.searchsorted(y, shared)]).sum())
    whole = n_x + n_y - common
    return common / whole if whole else 0.0


def similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (a, b) whose exact similarity reaches ``least``."""

    def run(batches):
        for batch in batches:
            a, b, *rest = (c.to_pylist() for c in batch.columns)
            found = [(x, y, similarity(*own)) for x, y, *own in zip(a, b, *rest)]
            cols = list(zip(*((x, y, s) for x, y, s in found if s >= least))) or ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.float64())], names=["a", "b", "similarity"])

    tasks = max(1, -(-pairs.count() // PAIRS_A_TASK))
    spread = pairs.repartition(tasks, "a", "b")  # few bytes, but much work
    left, right = (sets.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("shingles").alias(f"set_{x}"),
                               F.col("counts").alias(f"many_{x}")) for x in "ab")
    both = spread.join(left, "a").join(right, "b")
    return both.select("a", "b", "n_a", "n_b", "set_a", "set_b", "many_a", "many_b").mapInArrow(
        lean(run), "a long, b long, similarity double")


def alike_in_blocks(active: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between texts of one bucket, but two components.

    All pairs of a bucket are looked at inside tasks, never written: members
    are dealt to blocks of about ``BLOCK`` and each pair of blocks is a group.
    Sketches choose the pairs for the exact check; a pair of similarity
    ``least`` fails that choice with probability 3e-6.
    """
    cut = SKETCH * least - 4.5 * np.sqrt(SKETCH * least * (1 - least))

    def compare(key, found):
        low, high = key[1].as_py(), key[2].as_py()
        node, component, n, block = (found.column(c).to_numpy() for c in ("node", "component", "n", "block"))
        sketch = np.frombuffer(b"".join(found.column("sketch").to_pylist()), np.uint8).reshape(len(node), SKETCH)
        sets_of, counts = found.column("shingles").to_pylist(), found.column("counts").to_pylist()
        rows, cols = np.flatnonzero(block == low), np.flatnonzero(block == high)
        out = []
        for i in rows:
            with_ = cols[(component[cols] != component[i]) & (np.minimum(n[cols], n[i]) >= least * np.maximum(n[cols], n[i]))]
            if low == high:
                with_ = with_[node[with_] > node[i]]
            near = with_[np.count_nonzero(sketch[with_] == sketch[i], axis=1) >= cut]
            out += [(min(node[i], node[j]), max(node[i], node[j])) for j in near
                    if similarity(n[i], n[j], sets_of[i], sets_of[j], counts[i], counts[j]) >= least]
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    blocks = active.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = (active.join(blocks, "bucket").join(sets, "node")
             .withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))
    return (dealt.select("bucket", "low", "high", "node", "component", "n", "block", "sketch", "shingles", "counts")
            .groupBy("bucket", "low", "high").applyInArrow(compare, "a long, b long").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, by alternating large-star
    and small-star steps, each a join with a per-node minimum."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = land(small, "star")
        r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(r) == state or not r[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = tuple(r)


def link_texts(rows: DataFrame, sets: DataFrame, least: float) -> DataFrame | None:
    """Links (a, b) between texts that share a band, enough to connect all that
    are alike. ``rows`` are (bucket, node) of buckets with several texts.

    First every bucket compares its texts with its most popular one (that which
    shares most buckets), so a group of like texts costs one comparison a text.
    Buckets that then still hold several components compare the texts of
    different components, so no pair that shares a band is passed over.
    """
    if not rows.head(1):
        return None
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    popular = rows.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("popular"))
    hubs = (rows.join(popular, "node").groupBy("bucket")
            .agg(F.max(F.struct("popular", F.negative("node").alias("node"), F.col("node").alias("hub")))["hub"].alias("b")))
    star = land(rows.join(hubs, "bucket").where("node <> b").select(F.col("node").alias("a"), "b").distinct(), "pairs")
    links = land(similar(star, sets, least), "links")
    known = components(links)
    now = rows.join(known, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    several = now.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("n")
                                        ).where("x < y and n > 2").select("bucket")
    active = land(now.join(several, "bucket", "left_semi"), "active")
    return links.select("a", "b").union(land(alike_in_blocks(active, sets, least), "links"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, least: float = SIMILARITY, bands: int = BANDS,
                    rows: int = ROWS, counted: bool = False) -> DataFrame:
    """Class of each document: equal texts, and texts linked by a similarity of
    at least ``least`` over runs of ``size`` words, directly or through others.

    Similarity is the weighted Jaccard similarity of a text's shingles; a
    shingle weighs 1, or its number of occurrences if ``counted``. Returns one
    row per input row: doc_id, node (identity of the text), class_id (the
    smallest doc_id in the class), class_size (rows) and kept (the row has the
    smallest doc_id, and of texts with that id the smallest node).

    Defined cases: a null text is a class by itself; equal texts without words
    are one class, as are equal texts of fewer than ``size`` words, whose one
    shingle is the whole text; rows with a null doc_id take part, and a class
    of only such rows has a null class_id; repeated rows are in one class, all
    of them kept if their doc_id is; an empty table gives no rows; other
    columns are not looked at.
    """
    hashed = land(band_hashes(docs, bands, rows, size, counted), "bands")
    nodes = hashed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    one_each = hashed.where("node is not null").groupBy("node").agg(F.min_by("bands", F.coalesce("doc_id", F.lit(0))).alias("bands"))
    buckets = one_each.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = land(buckets.join(shared, "bucket", "left_semi"), "shared-buckets")
    wanted = members.select("node").distinct().join(nodes, "node")
    source = docs.select("doc_id", node(docs).alias("node"), text_column(docs).alias("text")).where("node is not null").alias("d")
    texts = land(source.join(wanted.alias("w"), (F.col("d.node") == F.col("w.node")) & F.col("d.doc_id").eqNullSafe(F.col("w.first")))
                 .select("d.node", "d.text"), "texts")
    repeated = texts.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node")
    if repeated.head(1):  # rows that repeat both text and doc_id
        twice = texts.join(repeated, "node", "left_semi").dropDuplicates(["node"])
        texts = land(texts.join(repeated, "node", "left_anti").unionByName(twice), "texts")
    links = link_texts(members, land(text_sets(texts, size, counted), "text-sets"), least)
    if links is not None:
        hashed = hashed.join(components(links), "node", "left")
    else:
        hashed = hashed.withColumn("component", F.lit(None).cast("long"))
    placed = land(hashed.select("doc_id", "node", F.coalesce("component", "node").alias("class")), "placed")
    classes = placed.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.min(F.struct("doc_id", "node")).alias("_first"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "node"))).alias("_named"))
    first = F.coalesce("_named", "_first")
    joined = placed.join(classes, "class", "left")
    kept = F.col("node").isNull() | (F.col("doc_id").eqNullSafe(first["doc_id"]) & (F.col("node") == first["node"]))
    alone = F.col("node").isNull()
    return joined.select("doc_id", "node", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                         F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
                         kept.alias("kept"))


def drop_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The input rows of one document of each class, all columns as they were."""
    found = near_duplicates(docs, **options)
    own, of, rows = (free_name(docs, c) for c in ("_id", "_node", "_rows"))
    keepers = land(found.where("kept and node is not null").groupBy(F.col("doc_id").alias(own), F.col("node").alias(of))
                   .agg(F.count(F.lit(1)).alias(rows)), "keepers")
    same = docs["doc_id"].eqNullSafe(F.col(own)) & (node(docs) == F.col(of))
    kept = docs.join(keepers, same)
    columns = [docs[c] for c in docs.columns]
    once = kept.where(F.col(rows) == 1).select(*columns)
    again = kept.where(F.col(rows) > 1).dropDuplicates([own, of]).select(*docs.columns)
    return once.unionByName(again).unionByName(docs.where(text_column(docs).isNull()))
