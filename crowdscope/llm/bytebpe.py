"""Byte-level BPE: exact encoding in linear time by longest matches and
backtracking over compatible neighbours, and decoding."""

from __future__ import annotations

import base64
import sys
import types
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdscope.llm.common import annotate, free_name, row_slices

#: Entries of a generation of a Python worker's memos: words, words with punctuation.
MEMO = 160_000
#: The same for chunks of texts that are cut by kinds of characters, and for neighbour pairs.
CHUNKS, PAIRS = 240_000, 400_000
#: Longest chunk of text, in characters, that is remembered.
SHORT = 48
#: Pieces of a long chunk that are held at once.
STEP = 1 << 15
#: Text bytes that are cut at once; a longer row is read by itself.
CUT_BYTES = 1 << 21
#: The pattern whose borders between kinds of characters ``cuts`` knows.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER, LETTER, NUMBER, APOSTROPHE, SPACE, BLANK = range(6)
NEVER = 1 << 40
MISSING = object()

ENCODED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64, blank, id on each line), read by Spark."""
    rows = spark.read.text(path).where(F.length(F.trim("value")) > 0).collect()  # a vocabulary: some 50,000 lines
    return {base64.b64decode(a): int(b) for a, b in (r.value.split() for r in rows)}


def merged(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """What plain merging (lowest rank first, leftmost of equals) leaves just
    before its last merge: two parts, or whatever can't be merged on."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
        if rank == NEVER:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def tables(ranks: dict[bytes, int]) -> tuple[list[bytes], list[int], list[int], list[int]]:
    """Tokens by place; the places of the two parts whose merge makes each
    token (-1: a byte, -2: no merge makes it); its longest proper prefix that merges make."""
    size = max(ranks.values(), default=-1) + 1
    tokens, left, right, shorter = [b""] * size, [-2] * size, [-2] * size, [-1] * size
    for token, rank in ranks.items():
        tokens[rank] = token
        if len(token) == 1:
            left[rank] = right[rank] = -1
        else:
            parts = merged(token, ranks)
            if len(parts) == 2 and parts[0] in ranks and parts[1] in ranks:
                left[rank], right[rank] = ranks[parts[0]], ranks[parts[1]]
    for token, rank in ranks.items():
        for n in range(len(token) - 1, 0, -1):
            if left[head := ranks.get(token[:n], rank)] != -2 and head != rank:
                shorter[rank] = head
                break
    return tokens, left, right, shorter


def kinds() -> np.ndarray:
    """The kind of every code point, as the pattern's engine sees it."""
    import regex
    every, out = "".join(map(chr, range(sys.maxunicode + 1))), np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[m.start():m.end()] = kind
    out[ord("'")], out[ord(" ")] = APOSTROPHE, BLANK
    return out


def cuts(kind: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a match of the known pattern surely begins at each character of
    the rows that begin at ``starts``.

    A match ends where the kind of character changes, but a blank goes with
    what follows it, and an apostrophe may go with letters (no cut there). Of
    several white characters before another one, the last stands apart.
    """
    cut = np.zeros(len(kind), bool)
    if not len(kind):
        return cut
    white, apostrophe = kind >= SPACE, kind == APOSTROPHE
    solid = np.where(apostrophe, OTHER, kind)
    begins = np.zeros(len(kind) + 1, bool)
    begins[starts], begins[-1] = True, True
    follows = np.zeros(len(kind), bool)  # another than a white character of the same row
    follows[:-1] = ~white[1:] & ~begins[1:-1]
    before, after = kind[:-1], kind[1:]
    apart = (solid[:-1] != solid[1:]) & ~((before == BLANK) | apostrophe[:-1] & (after == LETTER))
    cut[1:] = np.where(white[1:], ~white[:-1] | follows[1:], apart)
    return cut | begins[:-1]


class Encoder:
    """Ids of texts and bytes of ids, for one vocabulary."""

    def __init__(self, tokens: list[bytes], left: list[int], right: list[int], shorter: list[int], pattern: str):
        import ahocorasick
        import regex
        self.tokens, self.left, self.right, self.shorter = tokens, left, right, shorter
        self.size = [len(t) for t in tokens]
        self.ranks = {t: i for i, t in enumerate(tokens) if t}
        self.pieces = regex.compile(pattern)
        self.machine = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            if t and left[i] != -2:
                self.machine.add_word(t.decode("latin-1"), i)
        self.most = max(self.size, default=0)
        self.pairs: dict[int, bool] = {}
        # pieces without a blank before them; words after a blank, and those met lately only
        self.pieces_seen: dict[str, tuple[int, ...]] = {}
        self.after_blank: dict[str, tuple[int, ...] | None] = {}
        self.before: dict[str, tuple[int, ...] | None] = {}
        # chunks of texts that are cut by kinds of characters, and those met lately only
        self.kinds = kinds() if pattern == KNOWN_PATTERN else None
        self.chunks: dict[bytes, tuple[int, ...]] = {}
        self.chunks_before: dict[bytes, tuple[int, ...]] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging keeps the border between neighbours ``a`` and ``b``.

        The part of ``a`` at the border grows along its right edge, that of
        ``b`` along its left edge. Whichever merge has the lowest rank is
        next; the border falls if the merge across it comes first (before an
        equal one inside ``b``, after an equal one inside ``a``).
        """
        xs, ys = [a], [b]
        while (x := self.right[xs[-1]]) >= 0:
            xs.append(x)
        while (y := self.left[ys[-1]]) >= 0:
            ys.append(y)
        kept = True
        while True:
            x, y = xs.pop(), ys.pop()
            next_x, next_y = xs[-1] if xs else NEVER, ys[-1] if ys else NEVER
            across = self.ranks.get(self.tokens[x] + self.tokens[y], NEVER)
            if across < next_x and across <= next_y and across != NEVER:
                kept = False
                break
            if not xs and not ys:
                break
            if next_x <= next_y:  # grow a's part
                ys.append(y)
            else:
                xs.append(x)
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[a << 24 | b] = kept
        return kept

    def piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern, not empty."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n, text = len(data), data.decode("latin-1")
        size, shorter, known, most = self.size, self.shorter, self.pairs.get, self.most
        reach, token_of = self.machine.longest_prefix, self.machine.get
        longest: dict[int, int] = {}  # by first byte, where it was asked for

        def find(at: int) -> int:
            token, k = -1, reach(text[at:at + most])
            while k and (token := token_of(text[at:at + k], -1)) < 0:
                k -= 1
            longest[at] = token = max(token, 0)
            return token

        token = find(0)
        at, last, out, dead = size[token], token, [token], None  # a first token fits anywhere
        while at < n:
            token = longest[at] if at in longest else find(at)
            while True:
                end = at + size[token]
                if dead is None or not dead[end]:
                    kept = known(last << 24 | token) if out else True
                    if self.compatible(last, token) if kept is None else kept:
                        out.append(token)
                        at, last = end, token
                        break
                token = shorter[token]
                while token < 0:  # no token goes on from here: the one before was too long
                    dead = dead or bytearray(n + 1)
                    dead[at] = 1
                    token = out.pop()
                    at -= size[token]
                    last = out[-1] if out else -1
                    token = shorter[token]
        return out

    def keep(self, word: str, ids: tuple[int, ...] | None) -> None:
        """Remember a word's ids. A full memo becomes the one before, which
        gives back what is met again; what isn't is forgotten with it."""
        if len(self.after_blank) >= MEMO:
            self.before, self.after_blank = self.after_blank, {}
        self.after_blank[word] = ids

    def chunk(self, text: str) -> tuple[int, ...]:
        """Ids of a short text."""
        out: list[int] = []
        pieces = self.pieces.findall(text)
        for p in pieces:
            word = p[1:] if p[0] == " " and len(p) > 1 and not p[1].isspace() else None
            seen = self.pieces_seen if word is None else self.after_blank
            ids = seen.get(word or p) or (self.before.get(word) if word else None)
            if ids is None:
                ids = tuple(self.piece(p.encode()))
                if word is None:
                    if len(seen) >= MEMO // 4:
                        seen.clear()
                    seen[p] = ids
            if word and len(pieces) > 1:
                self.keep(word, ids)
            out += ids
        return tuple(out)

    def long(self, text: str) -> Iterator[list[int]]:
        """Ids of a text of any length, some pieces at a time."""
        found = self.pieces.finditer(text)
        while some := [m.group() for m in islice(found, STEP)]:
            yield [i for p in some for i in self.piece(p.encode())]

    def distinct(self, chunks: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of chunks that begin and end where matches do, remembered as in ``keep``."""
        out = []
        for data in chunks:
            ids = self.chunks.get(data)
            if ids is None:
                ids = self.chunks_before.get(data)
                if ids is None:
                    if b"'" in data:
                        ids = tuple(i for p in self.pieces.findall(data.decode()) for i in self.piece(p.encode()))
                    else:  # one match
                        ids = tuple(self.piece(data))
                if len(data) <= SHORT:
                    if len(self.chunks) >= CHUNKS:
                        self.chunks_before, self.chunks = self.chunks, {}
                    self.chunks[data] = ids
            out.append(ids)
        return out

    def together(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a slice, and row offsets into them: the rows are
        cut at sure borders of matches, and each distinct chunk is encoded once."""
        first = np.flatnonzero((raw & 0xC0) != 0x80)  # the byte that begins each character
        kind = self.kinds[np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4")]
        rows = np.unique(np.searchsorted(first, offsets[:-1][np.diff(offsets) > 0]))
        at = first[cuts(kind, rows)]
        bounds = np.r_[at, len(raw)].astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = chunks.dictionary_encode()
        found = self.distinct(coded.dictionary.to_pylist())
        number = coded.indices.to_numpy()
        size = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.dtype("<u4"), int(size.sum()))
        own, start = size[number], (np.cumsum(size) - size)[number]
        ends = np.r_[0, np.cumsum(own)]
        place = np.arange(ends[-1]) + np.repeat(start - ends[:-1], own)
        return ids[place], ends[np.searchsorted(at, offsets)]

    def rows(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """Numbers of ids and packed ids of rows of texts."""
        numbers, ids = [pa.array([], pa.int64())], [pa.array([], pa.binary())]
        for lo, hi in row_slices(offsets, CUT_BYTES):
            part, own = raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            if self.kinds is not None and len(part) <= CUT_BYTES:
                found, ends = self.together(part, own)
                numbers.append(pa.array(np.diff(ends), pa.int64()))
                ids.append(pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(found)]))
                continue
            for i in range(hi - lo):
                text = self.encode(part[own[i]:own[i + 1]].tobytes().decode())
                numbers.append(pa.array([len(text)], pa.int64()))
                ids.append(pa.array([packed(text)], pa.binary()))
        return pa.concat_arrays(numbers), pa.concat_arrays(ids)

    def encode(self, text: str) -> array:
        """The ids as unsigned 32-bit integers.

        A match ends before a blank that stands between other than white
        space, so the text is cut there and the ids of short chunks are
        remembered. A chunk that ends in white space is read with the next.
        """
        done, out = array("I"), []
        first, *words = text.split(" ")
        open_ = [first]  # what can't be cut off yet
        if first and not first[-1].isspace():
            out += self.chunk(first) if len(first) <= SHORT else [i for ids in self.long(first) for i in ids]
            open_ = []
        for word in words:
            if not open_:
                ids = self.after_blank.get(word, MISSING)
                if ids is MISSING:
                    ids = self.before.get(word, MISSING)
                    if ids is not MISSING:
                        self.keep(word, ids)
                    elif not word or word[-1].isspace():
                        ids = None
                    elif len(word) > SHORT:
                        for ids in self.long(" " + word):
                            done.extend(out)
                            out = ids
                        continue
                    else:
                        ids = self.chunk(" " + word)
                        self.keep(word, ids)
                if ids is not None:
                    out += ids
                    continue
                open_ = ["", word]
                continue
            open_.append(word)
            if word and not word[-1].isspace():
                for ids in self.long(" ".join(open_)):
                    done.extend(out)
                    out = ids
                open_ = []
        for ids in self.long(" ".join(open_)):
            done.extend(out)
            out = ids
        done.extend(out)
        return done


def packed(ids: array) -> bytes:
    return ids.tobytes() if sys.byteorder == "little" else np.asarray(ids, "<u4").tobytes()


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None, text: str = "text") -> tuple[DataFrame, str]:
    """Encode every whole text: a struct of ``n_tokens`` and ``ids`` (unsigned
    32-bit little-endian integers), exactly as merging by rank gives them for
    each match of ``pattern``. Special tokens don't exist: their strings are text.

    Defined cases: a null or empty text has no ids; repeated rows encode
    alike; an empty table gives an empty one; texts are cut where matches
    surely end, and each distinct chunk of two megabytes of texts is encoded once; a
    longer text is cut at blanks, a long run without blanks is read in steps,
    so a task holds the text and its ids; other columns, also of clashing names, are carried as
    they are. The vocabulary's tables (some MB) are broadcast. Returns the
    frame and the struct's name.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((*tables(read_ranks(spark, path)), pattern))

    def make():
        kept = sys.modules.setdefault("_byte_encoders", types.ModuleType("_byte_encoders")).__dict__
        key = f"{path} {pattern}"
        if key not in kept:
            kept[key] = Encoder(*shared.value)
        encoder = kept[key]

        def step(raw, offsets, nulls, batch):
            return encoder.rows(raw, offsets)

        return step

    return annotate(docs, "encoded", ENCODED, make, keep, text)


def decode(df: DataFrame, path: str, ids: str, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Append the bytes that packed ``ids`` (a binary column, or a field of a
    struct) stand for. Null ids decode to no bytes; an id outside the
    vocabulary is an error. Returns the frame and the column's name."""
    spark = df.sparkSession
    by_id = {i: t for t, i in read_ranks(spark, path).items()}
    shared = spark.sparkContext.broadcast(by_id)
    keep = df.columns if keep is None else keep
    name = free_name(df, "decoded")
    hidden = free_name(df, "ids__")
    out = T.StructType([*[T.StructField(c, df.schema[c].dataType, True) for c in keep], T.StructField(name, T.BinaryType(), True)])
    n_keep = len(keep)

    def run(batches):
        tokens = shared.value
        for batch in batches:
            made = []
            for i in range(batch.num_rows):
                packed_ids = batch.column(n_keep)[i].as_buffer()
                found = np.frombuffer(packed_ids, "<u4") if packed_ids is not None else ()
                made.append(b"".join([tokens[t] for t in found.tolist()]) if len(found) else b"")
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], pa.array(made, pa.binary())], names=[*batch.schema.names[:n_keep], name])

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(ids).alias(hidden)).mapInArrow(run, out), name

