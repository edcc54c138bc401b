"""Best-fit packing of tokenized documents by exact-complement hashing."""

from __future__ import annotations

import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdscope.llm.common import bound_batches, gapless_rank, land, lean, text_column

#: Split pattern of byte-level BPE tokenizers (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Text on which both libraries must agree before a task starts.
PROBE = "It's 12.5 % of  naïve\n\n text,\twith <|endoftext|> and \u6587\u5b57!!"


class ByteTokenizer:
    """Token ids (little-endian unsigned 32-bit) of whole texts, by a byte-level
    BPE file of the tokenizers library.

    The file's vocabulary is run by tiktoken, whose ids are the same at three
    to four times the speed; each task first compares the two on a probe. As
    the library reads it, a special token's string in a text is that token.
    The loaded tokenizer stays in the Python worker for later tasks.
    """

    def __init__(self, path: str):
        kept = sys.modules.setdefault("_byte_tokenizers", types.ModuleType("_byte_tokenizers")).__dict__
        if path not in kept:
            kept[path] = self.load(path)
        self.model = kept[path]

    @staticmethod
    def load(path: str):
        import tiktoken
        from tokenizers import Tokenizer
        whole = Tokenizer.from_file(path)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that a vocabulary writes as themselves
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}
        special = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in whole.get_vocab().items() if token not in special}
        model = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        if model.encode(PROBE, allowed_special="all") != whole.encode(PROBE, add_special_tokens=False).ids:
            raise ValueError(f"{path} is no byte-level BPE file with the usual split pattern")
        return model

    def __call__(self, text: str) -> bytes:
        return np.array(self.model.encode(text, allowed_special="all"), "<u4").tobytes()


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of ``n`` tokens: the first piece takes the odd rest."""
    if n <= capacity:
        return [0]
    rest = n % capacity
    return ([0] if rest else []) + list(range(rest, n, capacity))


def tokenize_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0, ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of each document, its ids ended by
    ``end_id``: doc_id, piece, start, length, ids_crc32 and, if asked, the ids."""
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        tokens = ByteTokenizer(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows, cols = [], ([], [], [], [], [])
                for i, text in enumerate(texts):
                    data = tokens(text) + end
                    n = len(data) // 4
                    starts = cut_points(n, capacity)
                    for k, a in enumerate(starts):
                        b = starts[k + 1] if k + 1 < len(starts) else n
                        piece = data[4 * a:4 * b]
                        rows.append(i)
                        for c, v in zip(cols, (k, a, b - a, zlib.crc32(piece),
                                               np.frombuffer(piece, "<u4").astype(np.int64) if ids else None)):
                            c.append(v)
                arrays = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int32()),
                          *(pa.array(c, pa.int64()) for c in cols[1:4])]
                if ids:
                    arrays.append(pa.array(cols[4], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    bound_batches(docs.sparkSession)
    return docs.select("doc_id", text_column(docs).alias("text")).mapInArrow(lean(run), T.StructType(fields))


def plan_packing(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequence patterns ``(how many sequences, [(length, items in each)])``.

    From the longest length down, the gap left beside an item is looked up
    among the sums of one, two and three available lengths; a combination that
    fills it exactly is used as often as the counts allow. What finds no exact
    complement goes to best-fit, longest first. The plan depends only on the
    histogram of lengths, so its size is bounded by the capacity.
    """
    cnt = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        cnt[length] += n
    plan: list[tuple[int, list[tuple[int, int]]]] = []

    def use(lengths: list[int]) -> None:
        own: dict[int, int] = {}
        for length in lengths:
            own[length] = own.get(length, 0) + 1
        k = min(int(cnt[length]) // m for length, m in own.items())
        for length, m in own.items():
            cnt[length] -= k * m
        plan.append((k, sorted(own.items(), reverse=True)))

    def available(lengths: list[int]) -> bool:
        return all(cnt[x] >= lengths.count(x) for x in lengths)

    def pair(own: list[int], gap: int) -> list[int] | None:
        """The two lengths of sum ``gap`` with the highest lower count."""
        a = np.arange((gap + 1) // 2, gap)
        if not len(a):
            return None
        both = np.minimum(cnt[a], cnt[gap - a])
        for at in np.argsort(-both, kind="stable")[:8]:
            if both[at] <= 0:
                return None
            found = [*own, int(a[at]), int(gap - a[at])]
            if available(found):
                return found
        return None

    def complement(length: int) -> list[int] | None:
        gap = capacity - length
        if gap == 0:
            return [length]
        if available([length, gap]):
            return [length, gap]
        if found := pair([length], gap):
            return found
        have = (cnt > 0).astype(float)
        sums = np.rint(np.convolve(have[:gap + 1], have[:gap + 1])[:gap + 1])
        third = np.arange(gap - 2, 0, -1)
        third = third[(have[third] > 0) & (sums[gap - third] > 0)] if len(third) else third
        for c in third:
            if available([length, int(c)]) and (found := pair([length, int(c)], int(gap - c))):
                return found
        return None

    rest: dict[int, int] = {}
    for length in range(capacity, 0, -1):
        while cnt[length]:
            found = complement(length)
            if found is None:
                rest[length] = int(cnt[length])
                cnt[length] = 0
            else:
                use(found)
    bins: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = {}
    for length, n in sorted(rest.items(), reverse=True):
        while n:
            fits = [g for g in bins if g >= length]
            if fits:
                gap = min(fits)
                many, pattern = bins[gap].pop()
                if not bins[gap]:
                    del bins[gap]
                m = min(gap // length, n)
                k = min(many, n // m)
                if k < many:
                    bins.setdefault(gap, []).append((many - k, pattern))
            else:
                gap, pattern = capacity, ()
                m = min(capacity // length, n)
                k = n // m
            n -= k * m
            bins.setdefault(gap - m * length, []).append((k, (*pattern, (length, m))))
    plan += [(k, list(pattern)) for kinds in bins.values() for k, pattern in kinds]
    return plan


def slots(plan: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length, which of its items (numbered from 0) go where: (length,
    first, end, items in each sequence, first sequence, offset of the first)."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for k, pattern in plan:
        offset = 0
        for length, m in pattern:
            first = taken.get(length, 0)
            taken[length] = first + k * m
            out.append((length, first, first + k * m, m, sequence, offset))
            offset += m * length
        sequence += k
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack all documents into as few sequences of ``capacity`` tokens as it can.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id and offset (gapless from 0 in each sequence). Only documents
    longer than a sequence are cut. Items of one length are interchangeable:
    the plan is made from the histogram of lengths (at most ``capacity`` rows
    on the driver) and items take its places by their rank within the length.

    Defined cases: a null or empty text is the end id alone; null and repeated
    ids are packed as any row; an empty table gives no rows; other columns are
    not looked at; equal lengths are ranked by a hash, then doc_id and piece.
    """
    spark = docs.sparkSession
    pieces = land(tokenize_pieces(docs, tokenizer, capacity, end_id), "pieces")
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = slots(plan_packing(counts, capacity))
    plan = spark.createDataFrame(places or [(0, 0, 0, 1, 0, 0)],
                                 "length long, first long, stop long, each long, sequence long, at long")
    by_length = plan.groupBy("length").agg(F.collect_list(F.struct("first", "stop", "each", "sequence", "at")).alias("places"))
    ranked = gapless_rank(pieces, "length", F.xxhash64("doc_id", "piece", "start"),
                          [F.col("doc_id"), F.col("piece"), F.col("start"), F.col("ids_crc32")], "_rank")
    chosen = ranked.join(F.broadcast(by_length), "length").withColumn(
        "_place", F.filter("places", lambda p: (p["first"] <= F.col("_rank")) & (F.col("_rank") < p["stop"]))[0])
    nth = F.col("_rank") - F.col("_place.first")
    return chosen.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_place.sequence") + F.expr("(_rank - _place.first) div _place.each")).alias("sequence_id"),
        (F.col("_place.at") + (nth % F.col("_place.each")) * F.col("length")).alias("offset"))


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The packed sequences themselves: sequence_id and its token ids."""
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ids = tokenize_pieces(docs, tokenizer, capacity, end_id, ids=True).dropDuplicates(key)
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
    joined = packed.alias("a").join(ids.alias("b"), same)
    parts = F.array_sort(F.collect_list(F.struct(F.col("a.offset").alias("offset"), F.col("b.ids").alias("ids"))))
    return joined.groupBy("a.sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
