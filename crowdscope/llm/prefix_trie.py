"""Prefix trie of conversations by peeling: from the greatest depth down, the
last turn of every path is stripped and equal paths merge."""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdscope.llm.common import land

#: Depths that one job peels: by one grouping for each depth, or inside tasks.
BAND, DEEP_BAND = 8, 64
#: Prefix keys below one ancestor up to which a task peels them (some 50 MB); beyond, every depth is a grouping.
TOGETHER = 400_000
#: Ids rendered into one piece of text.
IDS = 1 << 16
#: Rows that a task hands over at once.
STEP = 4096
ROOT = hashlib.sha256(b"").digest()


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of a turn; no two different (role, text) are written alike."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def order_turns(turns: DataFrame) -> DataFrame:
    """One row for each conversation: its turns' digests and text bytes in order."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), role.alias("role"), turn_digest(role, text).alias("digest"),
                 F.octet_length(text).cast("long").alias("bytes")).alias("one"))
    listed = slim.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def regroup(convs: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Every conversation rebuilt: the first ``head`` turns (``most`` at most)
    of conversation ``base``, then its own turns after its first ``head``."""
    own = convs.select("conv_id", base.alias("_base"), head.cast("int").alias("_head"), "turns")
    heads = convs.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, F.lit(most)).alias("_first"))
    nothing = F.slice("turns", 1, F.lit(0))
    mixed = F.concat(F.when(F.col("_head") > 0, F.slice(F.coalesce("_first", nothing), F.lit(1), F.greatest("_head", F.lit(1)))).otherwise(nothing),
                     F.slice("turns", F.col("_head") + 1, F.greatest(F.size("turns"), F.lit(1))))
    return own.join(heads, "_base", "left").select("conv_id", mixed.alias("turns"))


def paths(convs: DataFrame) -> DataFrame:
    """Keys of all prefixes of a conversation (the root's first; each hashes
    the one before and a turn) and the bytes of each prefix's last text."""
    def run(batches):
        for batch in batches:
            ids, digests, sizes, of_path, of_size = batch.column(0), batch.column(1), batch.column(2), [], []
            for i in range(batch.num_rows):
                path = [ROOT]
                for d in digests[i].as_py():
                    path.append(hashlib.sha256(path[-1] + d).digest())
                of_path.append(path)
                of_size.append([0, *sizes[i].as_py()])
            yield pa.RecordBatch.from_arrays([ids, pa.array(of_path, pa.list_(pa.binary())), pa.array(of_size, pa.list_(pa.int64()))],
                                             names=["conv_id", "path", "sizes"])

    slim = convs.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.bytes").alias("sizes"))
    return slim.mapInArrow(run, "conv_id long, path array<binary>, sizes array<long>")


SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def merge(states: DataFrame) -> DataFrame:
    """Equal paths become one state."""
    return states.groupBy("at", "key", "done").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS], *[F.first(c).alias(c) for c in ("path", "sizes", "parent")])


STATE = ("at int, key binary, done boolean, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "path array<binary>, sizes array<long>, parent binary")
NAMES = [c.split()[0] for c in STATE.split(", ")]


def peel(states: DataFrame, depth: int) -> DataFrame:
    """Merge the states at ``depth``; each gives a finished node and, one turn
    shorter, a state at the next depth. All other rows stay as they are."""
    parent = f"path[{depth - 1}]" if depth else "cast(null AS binary)"
    leaves, saved = "if(n_children = 0, 1L, n_leaves)", f"saved_tokens + (n_convs - 1) * sizes[{depth}]"

    def row(*values):
        return "named_struct(" + ", ".join(f"'{c}', {v}" for c, v in zip(NAMES, values, strict=True)) + ")"

    node = row("at", "key", "true", "conv_id", "n_convs", "n_children", leaves, saved,
               "cast(null AS array<binary>)", "cast(null AS array<bigint>)", parent)
    shorter = row("at - 1", parent, "false", "conv_id", "n_convs", "1L", leaves, saved,
                  f"slice(path, 1, {depth})", f"slice(sizes, 1, {depth})", "cast(null AS binary)")
    made = f"array({node}, {shorter})" if depth else f"array({node})"
    return merge(states).selectExpr(f"inline(if(at = {depth} AND NOT done, {made}, array({row(*NAMES)})))")


def peel_inside(states: DataFrame, top: int, foot: int) -> DataFrame:
    """All depths from ``top`` down to ``foot`` + 1 in one exchange: the states
    below one ancestor at ``foot`` meet in a task, which peels them."""
    def peeled(rows):
        ended: dict[int, list] = {}
        for r in rows:
            ended.setdefault(r["at"], []).append(r)
        live: dict[bytes, dict] = {}
        for depth in range(top, foot, -1):
            for r in ended.pop(depth, ()):
                own = live.get(r["key"])
                if own is None:
                    live[r["key"]] = r
                else:
                    own["conv_id"] = min(own["conv_id"], r["conv_id"])
                    for c in SUMS:
                        own[c] += r[c]
            shorter: dict[bytes, dict] = {}
            for r in live.values():
                path, parent = r["path"], r["path"][depth - 1]
                if not r["n_children"]:
                    r["n_leaves"] = 1
                r["saved_tokens"] += (r["n_convs"] - 1) * r["sizes"][depth]
                yield r | {"at": depth, "done": True, "path": None, "sizes": None, "parent": parent}
                own = shorter.get(parent)
                if own is None:
                    shorter[parent] = r | {"at": depth - 1, "key": parent, "n_children": 1, "path": path}
                else:
                    own["conv_id"] = min(own["conv_id"], r["conv_id"])
                    own["n_children"] += 1
                    for c in ("n_convs", "n_leaves", "saved_tokens"):
                        own[c] += r[c]
            live = shorter
        for r in live.values():
            yield r | {"path": r["path"][:foot + 1], "sizes": r["sizes"][:foot + 1]}

    def run(batches):
        rows = (r for b in batches for r in b.to_pylist())
        kind = None
        for _, group in groupby(rows, key=lambda r: r.pop("near")):
            found = peeled(group)
            while some := list(islice(found, STEP)):
                kind = kind or pa.schema([("at", pa.int32()), ("key", pa.binary()), ("done", pa.bool_()), *[(c, pa.int64()) for c in NAMES[3:8]],
                                          ("path", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64())), ("parent", pa.binary())])
                yield pa.RecordBatch.from_pylist(some, schema=kind)

    return states.repartition("near").sortWithinPartitions("near").mapInArrow(run, STATE)


def grow_trie(ended: DataFrame) -> DataFrame:
    """All nodes of the trie over ``ended``: landed states, one for each
    distinct whole path, sorted by their depth ``at``.

    A job peels a band of depths. Below depth 8, where no ancestor at the
    band's foot has many states, they are dealt by it once and peeled inside
    tasks; else (near the root, or below a hot long prefix) every depth is a
    grouping of its own, with partial sums before its exchange, so a hot path
    is one row a task.
    """
    deepest = ended.agg(F.max("at")).first()[0]
    live, finished, top = None, [], -1 if deepest is None else deepest
    while top >= 0:
        made, foot = None, max(top - DEEP_BAND, BAND)
        if foot < top:
            states = ended.where(F.col("at").between(foot + 1, top))
            states = (states if live is None else states.unionByName(live)).withColumn("near", F.element_at("path", foot + 1))
            most = states.groupBy("near").agg(F.sum(F.size("path")).alias("n")).agg(F.max("n")).first()[0] or 0
            if most <= TOGETHER:
                made = peel_inside(states, top, foot)
        if made is None:
            foot = max(top - BAND, BAND) if top > BAND else -1
            made = ended.where(F.col("at").between(foot + 1, top))
            made = made if live is None else made.unionByName(live)
            for depth in range(top, foot, -1):
                made = peel(made, depth)
        made = land(made.select(*NAMES), "trie-band")
        finished.append(made.where("done"))
        live, top = made.where("not done"), foot
    return reduce(DataFrame.unionByName, finished, ended.where("done"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each key's conversation ids, ascending, in decimal, joined by
    commas. Ids are rendered into pieces by tasks that share the ids of a hot
    key; then one task hashes a key's pieces as a stream."""
    def render(batches):
        key, first, ids = None, 0, []
        rows = ((k, c) for b in batches for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))

        def made():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([first], pa.int64()),
                                               pa.array([",".join(ids)], pa.string())], names=["key", "first", "ids"])

        for k, c in rows:
            if ids and (k != key or len(ids) >= IDS):
                yield made()
                ids = []
            if not ids:
                key, first = k, c
            ids.append(str(c))
        if ids:
            yield made()

    def hashed(batches):
        key, sha = None, None

        def made():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()], pa.string())], names=["key", "ends_sha256"])

        for b in batches:
            for k, text in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                if sha is not None and k == key:
                    sha.update(b",")
                else:
                    if sha is not None:
                        yield made()
                    key, sha = k, hashlib.sha256()
                sha.update(text.as_buffer())
        if sha is not None:
            yield made()

    parts = ends.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = ends.select("key", "conv_id").repartitionByRange(int(parts), "key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = land(dealt.mapInArrow(render, "key binary, first long, ids string"), "trie-ends")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "key binary, ends_sha256 string")


def build_trie(turns: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Nodes of the prefix trie over conversations that are rebuilt by
    ``regroup``; ``base`` and ``head`` are expressions over ``conv_id``.

    Defined cases: turns without a conversation id take no part; a null role or
    text is empty, a null turn number comes first, equal ones are ordered by
    role and digest; repeated rows are turns of their own; a conversation left
    without turns ends at the root; an empty table has no nodes; long texts
    are hashed by their own rows, a conversation is held as digests only;
    other columns take no part. Returns for each node its smallest member
    ``conv_id``, ``depth``, the parent's, and the counts and digest of its members.
    """
    convs = land(order_turns(turns), "trie-conversations")
    whole = land(paths(regroup(convs, base, head, most)), "trie-paths")
    at = F.size("path") - 1
    key, zero, none = F.element_at("path", -1).alias("key"), F.lit(0).cast("long"), F.lit(None).cast("binary")
    states = whole.select((F.size("path") - 1).alias("at"), key, F.lit(False).alias("done"), "conv_id", F.lit(1).cast("long").alias("n_convs"),
                          *[zero.alias(c) for c in SUMS[1:]], "path", "sizes", none.alias("parent"))
    ended = land(merge(states).select(*NAMES).repartitionByRange("at").sortWithinPartitions("at"), "trie-states")
    nodes = grow_trie(ended)
    ends = ends_digests(whole.select(key, "conv_id"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(above, "parent", "left").join(ends, "key", "left")
            .select("conv_id", F.col("at").cast("long").alias("depth"), "parent_conv_id", *SUMS,
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))
