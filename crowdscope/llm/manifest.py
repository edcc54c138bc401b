"""Merkle manifest of a dataset: trees of fan-out 8 over the rows of each
partition, built by grouping rank digits away inside bounded blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdscope.llm.common import land, text_column

FAN = 8
#: Levels nested in one block: at most 8 ** 3 nodes of some 150 bytes.
LEVELS = 3
PATH, TOPS = "array<struct<left:string,right:string>>", "struct<subroot:string,root:string>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 bytes after their number and a colon."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ordered_rank(df: DataFrame, key: str, order: list[Column]) -> tuple[DataFrame, int]:
    """Number the rows of each ``key`` from 0 by ``order`` (``rank``) and count
    them (``total``).

    Rows are dealt by ranges of (key, order, place in the input), so a key or
    an order value that a third of all rows share is spread over tasks. Each
    task numbers its own rows; the rows of each key in earlier tasks (one row
    a task and key) are added. Returns the rows and the largest ``total``.
    """
    placed = land(df.withColumn("_place", F.monotonically_increasing_id()), "merkle-rows")
    by = [F.col(key).asc_nulls_first(), *order, F.col("_place")]
    dealt = land(placed.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("_at", 33)
    sizes = dealt.groupBy(key, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_least"))
    every = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(F.col(key).alias("_key"), "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least")).alias("_shift"),
                          F.sum("_n").over(every).alias("total"))
    most = firsts.agg(F.max("total")).first()[0] or 0
    ranked = dealt.join(firsts, F.col(key).eqNullSafe(F.col("_key")) & (part == F.col("_part")))
    return ranked.withColumn("rank", F.col("_at") + F.col("_shift")).drop("_place", "_at", "_key", "_part", "_shift"), most


def folded(children: Column) -> Column:
    return digest(F.array_join(F.transform(children, lambda c: c["hash"]), ""))


def nest(nodes: DataFrame, key: str) -> DataFrame:
    """One row for each block of up to 512 consecutive nodes of a key: its
    nodes nested three levels deep, the lowest digit grouped away first.

    ``nodes`` has the key, ``rank``, ``total`` (nodes of the key), ``hash`` and
    ``row`` (what a node carries). A level of a single node is passed on, not hashed.
    """
    digits = [f"_digit{i}" for i in range(LEVELS)]
    block = F.expr(f"rank div {FAN ** LEVELS}")
    dealt = nodes.select(F.col(key), "total", block.alias("block"), F.struct("hash", "row").alias("node"),
                         *[F.expr(f"rank div {FAN ** i} % {FAN}").cast("int").alias(d) for i, d in enumerate(digits)])
    dealt = dealt.repartition(F.col(key), F.col("block"))  # the groupings below need no other exchange
    for i, d in enumerate(digits):
        left = [key, "block", "total", *digits[i + 1:]]
        child = F.struct(F.col(d).alias("digit"), *[F.col(f"node.{c}").alias(c) for c in (["hash", "row"] if i == 0 else ["hash", "nodes"])])
        run = dealt.groupBy(*left).agg(F.sort_array(F.collect_list(child)).alias("nodes"))
        # at this level a key has ceil(total / 8 ** i) nodes
        whole = F.when(F.col("total") > FAN ** i, folded(F.col("nodes"))).otherwise(F.element_at("nodes", 1)["hash"])
        dealt = run.select(*left, F.struct(whole.alias("hash"), "nodes").alias("node"))
    return dealt.select(key, "block", "total", F.col("node.hash").alias("hash"), F.col("node.nodes").alias("nodes"))


def beside(nodes: Column, i: Column) -> Column:
    """Hashes of a run before and after node ``i``, as texts."""
    text = lambda part: F.array_join(F.transform(part, lambda c: c["hash"]), "")
    return F.struct(text(F.slice(nodes, 1, i)).alias("left"), text(F.slice(nodes, i + 2, F.lit(FAN))).alias("right"))


def proofs(blocks: DataFrame, key: str, above: DataFrame | None) -> DataFrame:
    """One row for each lowest node of the blocks: its ``row``, its ``path``
    (the hashes beside it, level by level up to the top) and its ``tops``.

    ``above`` has (key, block, path, tops) of the blocks' own tops. Both meet
    in one grouping by block; the nested structs then give all paths by
    ``transform`` and ``explode``.
    """
    if above is None:
        nothing = F.struct(F.array().cast(PATH).alias("path"), F.lit(None).cast(TOPS).alias("tops"))
        whole = blocks.select(key, "total", "nodes", nothing.alias("up"))
    else:
        both = blocks.select(key, "block", "total", "nodes").unionByName(
            above.select(key, "block", F.struct("path", "tops").alias("up")), allowMissingColumns=True)
        whole = both.groupBy(key, "block").agg(*[F.first(c, True).alias(c) for c in ("total", "nodes", "up")])
    total = F.col("total")

    def deeper(nodes, level, path):
        def one(c, i):
            # a level of one node in all has no run of its own
            mine = F.when(total > FAN ** level, F.concat(F.array(beside(nodes, i)), path)).otherwise(path)
            return deeper(c["nodes"], level - 1, mine) if level else F.array(F.struct(c["row"].alias("row"), mine.alias("path")))
        return F.flatten(F.transform(nodes, one))

    emitted = F.explode(deeper(F.col("nodes"), LEVELS - 1, F.col("up.path"))).alias("_one")
    return whole.select(key, F.col("up.tops").alias("tops"), emitted).select(key, "_one.row", "_one.path", "tops")


def grow(leaves: DataFrame, key: str, order: list[Column]) -> list[DataFrame]:
    """Trees over the rows of each key: the landed blocks of every three
    levels; the last ones hold the tops. ``leaves`` has the key, ``hash`` and ``row``."""
    nodes, most = ordered_rank(leaves, key, order)
    rounds = [land(nest(nodes, key), "merkle-blocks")]
    while most > FAN ** LEVELS:
        most = -(-most // FAN ** LEVELS)
        fewer = F.ceil(F.col("total") / FAN ** LEVELS).cast("long")
        nodes = rounds[-1].select(key, F.col("block").alias("rank"), fewer.alias("total"), "hash", F.struct("block").alias("row"))
        rounds.append(land(nest(nodes, key), "merkle-blocks"))
    return rounds


def unfold(rounds: list[DataFrame], key: str, above: DataFrame | None = None) -> DataFrame:
    """Paths of all leaves, from the top blocks down. ``above``: (key, path, tops) of the tops."""
    if above is not None:
        above = above.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(rounds[1:]):
        above = land(proofs(blocks, key, above).select(key, "row.block", "path", "tops"), "merkle-paths")
    return proofs(rounds[0], key, above)


def fold(leaf: Column, path: Column) -> Column:
    """Top hash that a leaf and the hashes beside it give."""
    return F.aggregate(path, leaf, lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]).cast("binary"), 256))


def build_manifest(docs: DataFrame, fields: list[str], id_column: str = "doc_id", part: str = "lang", text: str = "text",
                   tampered: Column | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of every row.

    A leaf is the SHA-256 of the row's ``fields``. Leaves of each ``part``
    ascend by id; every 8 consecutive nodes become their hash until one is
    left, the subroot; subroots in order of ``part`` (null first, UTF-8
    bytewise) give the root alike. Rows where ``tampered`` holds are folded
    again from a leaf whose text has its A-Z lower-cased.

    Defined cases: null fields hash as ``-``, so a null and an empty text
    differ; a null part is a partition of its own, a null id comes first; rows
    of equal id ascend by leaf, wholly equal rows have equal leaves at
    consecutive places; an empty table has no rows; a text is hashed whole by
    its own row, only hashes move; other columns, also of clashing names,
    take no part. Returns id, part, leaf, subroot, root, proof (hashes
    beside, level by level), folded_root, verified.
    """
    def leaf_of(body: Column) -> Column:
        return digest(*[field(body if c == text else docs[c]) for c in fields])

    own = leaf_of(text_column(docs, text))
    bad = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    other = F.when(bad, leaf_of(F.translate(text_column(docs, text), UPPER, LOWER)))
    slim = docs.select(docs[part].cast("string").alias("part"), own.alias("hash"),
                       F.struct(docs[id_column].alias("id"), own.alias("leaf"), other.alias("tampered")).alias("row"))
    rounds = grow(slim, "part", [F.col("row.id").asc_nulls_first(), F.col("hash")])
    subroots = rounds[-1].select(F.lit(0).alias("all"), "hash", F.struct("part", "hash").alias("row"))
    upper = unfold(grow(subroots, "all", [F.col("row.part").asc_nulls_first()]), "all")
    tops = F.struct(F.col("row.hash").alias("subroot"), fold(F.col("row.hash"), F.col("path")).alias("root"))
    leaves = unfold(rounds, "part", land(upper.select("row.part", "path", tops.alias("tops")), "merkle-tops"))
    done = leaves.select(F.col("row.id").alias("id"), "part", F.col("row.leaf").alias("leaf"), "tops.subroot", "tops.root",
                         F.col("path").alias("proof"), fold(F.coalesce("row.tampered", "row.leaf"), F.col("path")).alias("folded_root"))
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all hashes of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda x: F.concat(x["left"], x["right"])), "").cast("binary"), 256)
