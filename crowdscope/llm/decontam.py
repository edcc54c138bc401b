"""Benchmark decontamination: one Aho-Corasick automaton over the normalised
benchmark texts, one scan of every document, hits mapped to the original."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdscope.llm.common import annotate, held

#: Consecutive words of one window.
WINDOW = 10
#: Benchmark text bytes in one automaton. A larger benchmark is dealt over
#: several automata, which a task builds one at a time, so neither the
#: broadcast nor a task's memory grows with the benchmark.
BLOCK_BYTES = 8 << 20

#: A-Z to a-z; ASCII bytes that are no letter or digit to a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first_char", T.LongType()),
                                                     T.StructField("end_char", T.LongType())])))])


def windows(text: bytes, size: int) -> list[str]:
    """The item's windows, as blank-delimited strings of one character a byte."""
    words = text.translate(FOLD).decode("latin-1").split(" ")
    words = [w for w in words if w]
    if not words:
        return []
    return [f" {' '.join(words[i:i + size])} " for i in range(max(1, len(words) - size + 1))]


def automaton(items: list[tuple[str, bytes]], size: int):
    """The automaton over all windows, and for each window its words and items."""
    owners: dict[str, set[str]] = {}
    for item, text in items:
        for w in windows(text, size):
            owners.setdefault(w, set()).add(item)
    auto = ahocorasick.Automaton()
    found = []
    for k, (w, ids) in enumerate(sorted(owners.items())):
        auto.add_word(w, k)
        found.append((w.count(" ") - 1, ids))
    if found:
        auto.make_automaton()
    return auto, found


def scan(raw: bytes, auto, found, ranges: list[tuple[int, int]], items: set[str]) -> int:
    """Add a text's hit word ranges and items; return its number of words."""
    words = raw.translate(FOLD).split()
    if words and found:
        line = b" " + b" ".join(words) + b" "
        blanks = None
        for end, k in auto.iter(line.decode("latin-1")):
            if blanks is None:
                blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
            last = int(np.searchsorted(blanks, end))
            n, ids = found[k]
            if ranges and ranges[-1][0] <= last - n <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(last, ranges[-1][1]))
            else:
                ranges.append((last - n, last))
            items |= ids
    return len(words)


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def char_spans(raw: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Character offsets in the original text of word ranges."""
    folded = np.frombuffer(raw.translate(FOLD), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], folded.view(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"first_char": int(chars[first[a]]), "end_char": int(chars[end[b - 1]])} for a, b in ranges]


def benchmark_blocks(bench: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's distinct items in blocks of about ``block_bytes``, one
    after the other: a block is what one broadcast holds."""
    items = (bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                          F.col("text").cast("string").alias("text"))
             .where(F.length("text") > 0).distinct())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r.item, r.text.encode()) for r in part.toLocalIterator()]


def find_benchmark(docs: DataFrame, bench: DataFrame, keep: list[str] | None = None, size: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """Mark each document with the benchmark windows it contains.

    Adds a struct: ``n_words``; ``n_hit``, the words inside any occurrence of
    a window; ``items``, the sorted ids of the items with an occurring window;
    ``spans``, the hit stretches as character offsets into the original text.
    Words, case and windows: ASCII A-Z are lower-cased, a word is a run of
    letters, digits and non-ASCII characters, a window is ``size`` consecutive
    words of an item or the whole of a shorter item.

    Defined cases: a null or empty text has no words and no hit; a null or
    empty item is no item, an item whose id is null is called ``null``; equal
    items count once for each id; with an empty benchmark nothing is hit; each
    repeated document row gets its own result; other columns, also of clashing
    names, are carried as they are. Returns the frame and the struct's name.
    """
    sc = docs.sparkSession.sparkContext
    shared = [sc.broadcast(b) for b in benchmark_blocks(bench, block_bytes)]

    def make():
        held("", lambda: None)
        kept = {}

        def step(raw, offsets, nulls, batch):
            n = len(offsets) - 1
            ranges, items, n_words = [[] for _ in range(n)], [set() for _ in range(n)], [0] * n
            data = raw.tobytes()
            for b, block in enumerate(shared):
                auto, found = kept.get(b) or automaton(block.value, size)
                vars(block).pop("_value", None)  # read again from the broadcast's file if built again
                if len(shared) == 1:
                    kept[b] = auto, found
                for i in range(n):
                    n_words[i] = scan(data[offsets[i]:offsets[i + 1]], auto, found, ranges[i], items[i])
            ranges = [merged(r) if r else r for r in ranges]
            spans = [char_spans(data[offsets[i]:offsets[i + 1]], r) if r else [] for i, r in enumerate(ranges)]
            kinds = pa.struct([("first_char", pa.int64()), ("end_char", pa.int64())])
            return [pa.array(n_words, pa.int64()), pa.array([sum(b - a for a, b in r) for r in ranges], pa.int64()),
                    pa.array([sorted(s) for s in items], pa.list_(pa.string())), pa.array(spans, pa.list_(kinds))]

        return step

    return annotate(docs, "benchmark_hits", RESULT, make, keep)
