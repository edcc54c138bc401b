"""Toxicity by nearest labelled examples: exact TF-IDF cosine through a
block-max inverted index, distance-weighted votes, calibrated scores."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdscope.llm.common import WordHasher, annotate, bound_batches, hash_below, held, land, lean, row_slices, text_column, text_parts, utf8_buffers

#: Labelled documents that are examples, of either label (expected number; dealt by a hash of the id).
TOXIC_ROWS, CLEAN_ROWS = 1000, 2000
#: Labelled documents at most (expected) that tell how reliable a term's vote is; their ids are broadcast (16 MB).
LABEL_ROWS = 1_000_000
#: Parts of the labelled documents; an example is calibrated by what the other parts tell.
FOLDS = 4
#: A term's label share counts as if it had so many more rows of the base rate.
TERM_PRIOR = 1.0
#: Nearest examples of each label that vote.
NEIGHBOURS = 20
#: Postings that a search reads before it first asks what else can be reached.
FIRST_POSTINGS = 100_000
#: Text bytes whose terms are held at once.
CHUNK_BYTES = 1 << 19
#: Examples in one block of the index.
BLOCK = 64
#: A term that more than this part of the examples hold has a row of weights instead of postings to read.
OFTEN = 1 / 8
REJECT = 0.7

RESULT = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
    T.StructField("terms", T.ArrayType(T.StringType())),
    T.StructField("evidence", T.ArrayType(T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("similarity", T.DoubleType()),
        T.StructField("toxic", T.IntegerType())])))])


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all runs of ``size`` entries from ``start`` on."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def highest(values: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` highest values above 0, highest first, ties to the lower place."""
    least = np.partition(values, len(values) - k)[len(values) - k] if len(values) > k else 0
    some = np.flatnonzero((values >= least) & (values > 0))
    return some[np.argsort(-values[some], kind="stable")][:k]


class BlockMaxIndex:
    """Postings by term over example vectors of length 1 (rows of ``first``,
    ``term``, ``weight``), with the highest weight of every term in each block
    of consecutive examples, and the weights of frequent terms as rows over all
    examples. Examples from ``split`` on are of the other label."""

    def __init__(self, first: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int, split: int):
        self.n, self.n_terms, self.split = len(first) - 1, n_terms, split
        self.first, self.term, self.weight = first, term, weight
        order = np.argsort(term, kind="stable")
        example, posted = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(first))[order], weight[order]
        # of each posting the example and the weight beside it, fetched together
        self.posting = np.stack([example, posted.astype(np.float32).view(np.int32)], 1).view(np.int64)[:, 0]
        by_term = term[order]
        self.start = np.searchsorted(by_term, np.arange(n_terms + 1))
        block = example // BLOCK
        cut = np.flatnonzero(np.r_[True, (by_term[1:] != by_term[:-1]) | (block[1:] != block[:-1])]) if len(order) else np.zeros(0, np.int64)
        self.block, self.highest = block[cut], np.maximum.reduceat(posted, cut) if len(cut) else np.zeros(0, np.float32)
        self.block_start = np.searchsorted(by_term[cut], np.arange(n_terms + 1))
        self.top = np.zeros(n_terms, np.float32)
        np.maximum.at(self.top, by_term[cut], self.highest)
        self.dense = np.zeros(n_terms)  # zero between calls
        size = np.diff(self.start)
        often = np.flatnonzero(size > OFTEN * self.n)
        self.row = np.full(n_terms, -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.rows, at = np.zeros((len(often), self.n), np.float32), spans(self.start[often], size[often])
        self.rows[np.repeat(np.arange(len(often)), size[often]), example[at]] = posted[at]

    def search(self, terms: np.ndarray, q: np.ndarray, told: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ``k`` examples of highest cosine of either label, ties to the
        lower example: their places, their cosines, and the sums that the
        cosines' parts times ``told`` give. Those from ``split`` on come last.

        Frequent terms are summed by rows; the others are read by falling bound. Once the block maxima of the others
        leave so few examples that can reach the k-th best of their label that
        scoring these in full takes less than reading on, this is done.
        """
        if not len(terms) or not self.n:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        order = np.lexsort((terms, -q * self.top[terms]))
        terms, q = terms[order], q[order].astype(np.float32)
        told, row = told[order], self.row[terms]
        often = row >= 0
        parts = self.rows[row[often]] * q[often, None]
        sums, rare = parts.sum(0, dtype=float), np.flatnonzero(~often)
        every, every_q, every_told = terms, q, told
        terms, q, told = terms[rare], q[rare], told[rare]
        size = self.start[terms + 1] - self.start[terms]
        read, budget, done, rounds = np.cumsum(size), FIRST_POSTINGS, 0, []
        while True:
            upto = max(done + 1, int(np.searchsorted(read, budget, side="right")))
            now = slice(done, upto)
            at = spans(self.start[terms[now]], size[now])
            got = self.posting.take(at).view(np.int32)
            example, part = got[::2], got[1::2].view(np.float32) * np.repeat(q[now], size[now])
            sums += np.bincount(example, part, self.n)
            rounds.append((now, example, part))
            done, budget = upto, budget * 2
            if without >= 0:
                sums[without] = 0
            if done >= len(terms):
                found = np.flatnonzero(sums > 0)
                exact = sums[found]
                break
            rest = terms[done:]
            n_blocks = self.block_start[rest + 1] - self.block_start[rest]
            at = spans(self.block_start[rest], n_blocks)
            bound = np.bincount(self.block[at], self.highest[at] * np.repeat(q[done:], n_blocks), -(-self.n // BLOCK))
            most = sums + np.repeat(bound, BLOCK)[:self.n]
            if without >= 0:
                most[without] = -1
            reach = []
            for lo, hi in ((0, self.split), (self.split, self.n)):
                least = np.partition(sums[lo:hi], hi - lo - k)[hi - lo - k] if hi - lo > k else 0.0
                reach.append(lo + np.flatnonzero(most[lo:hi] >= least - 1e-6) if least > 0 else np.arange(lo, hi))
            found = np.concatenate(reach)
            if (self.first[found + 1] - self.first[found]).sum() < read[-1] - read[done - 1]:
                exact, rounds = self.whole(found, every, every_q), None
                break
        exact = np.round(exact, 7)
        cut = int(np.searchsorted(found, self.split))  # examples rise
        best = np.concatenate([lo + highest(exact[lo:hi], k) for lo, hi in ((0, cut), (cut, len(found)))])
        near = found[best]
        if rounds is None:
            return near, exact[best], self.whole(near, every, every_q * every_told)
        votes, chosen = np.zeros(self.n), np.zeros(self.n, bool)
        chosen[near] = True
        for now, example, part in rounds:  # of the parts read, those of the examples found
            at = np.flatnonzero(chosen[example])
            term = np.searchsorted(np.cumsum(size[now]), at, side="right")
            votes += np.bincount(example[at], part[at] * told[now][term], self.n)
        return near, exact[best], votes[near] + (parts[:, near] * every_told[often, None]).sum(0, dtype=float)

    def whole(self, found: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The sums over ``terms`` of their ``weights`` times those of some examples."""
        own = self.first[found + 1] - self.first[found]
        at, row = spans(self.first[found], own), np.repeat(np.arange(len(found)), own)
        self.dense[terms] = weights
        out = np.bincount(row, self.dense[self.term[at]] * self.weight[at], len(found))
        self.dense[terms] = 0
        return out


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step means of ``y`` over ``x`` (pool adjacent violators), smoothed
    by half a case each way: the least and the largest ``x`` of every step with
    its mean, so that lines join the steps and a far case bends none of them."""
    blocks: list[list[float]] = []
    for v in np.unique(x):
        here = x == v
        blocks.append([v, (y[here] * weight[here]).sum(), weight[here].sum(), v])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, s, n, top = blocks.pop()
            blocks[-1][1] += s
            blocks[-1][2] += n
            blocks[-1][3] = top
    ends = [sorted({b[0], b[3]}) for b in blocks]
    return np.concatenate(ends), np.repeat([(b[1] + 0.5) / (b[2] + 1) for b in blocks], [len(e) for e in ends])


def reliability(hits: np.ndarray, rows: np.ndarray, base: float) -> np.ndarray:
    """How much a term tells of the label: the divergence of its toxic share from the base rate."""
    low = np.clip(base, 1e-6, 1 - 1e-6)
    share = np.clip((hits + TERM_PRIOR * low) / (rows + TERM_PRIOR), 1e-6, 1 - 1e-6)
    return np.maximum(share * np.log(share / low) + (1 - share) * np.log((1 - share) / (1 - low)), 0).astype(np.float32)


class Words:
    """Terms of a vocabulary (sorted word hashes) in whole texts."""

    def __init__(self, vocabulary: np.ndarray):
        self.vocabulary, self.hasher = vocabulary, WordHasher()
        self.inside = self.hasher.fold != 0

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row offsets, numbers and counts of the terms."""
        v, keys, counts = len(self.vocabulary), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, part, own in text_parts(raw, offsets, self.inside, CHUNK_BYTES) if v else ():
            words, rows, _, _ = self.hasher(part, own)
            at = np.minimum(np.searchsorted(self.vocabulary, words), v - 1)
            known = self.vocabulary[at] == words
            row = np.repeat(np.arange(lo, lo + len(own) - 1), np.diff(rows))
            k, n = np.unique(row[known] * v + at[known], return_counts=True)
            keys.append(k)
            counts.append(n)
        k, back = np.unique(np.concatenate(keys), return_inverse=True)  # parts of one row are summed
        n = np.bincount(back, np.concatenate(counts), len(k))
        return np.searchsorted(k, np.arange(len(offsets)) * v), k % max(v, 1), n

    def named(self, raw: np.ndarray, terms: np.ndarray) -> list[str]:
        """The words of one text that are these terms, sorted."""
        found, wanted = set(), self.vocabulary[terms]
        for _, part, own in text_parts(raw, np.array([0, len(raw)]), self.inside, CHUNK_BYTES) if len(terms) else ():
            words, _, start, stop = self.hasher(part, own)
            at = np.flatnonzero(np.isin(words, wanted))
            _, once = np.unique(words[at], return_index=True)
            found |= {self.hasher.fold[part[start[i]:stop[i]]].tobytes().decode("utf-8", "replace") for i in at[once]}
        return sorted(found)


def in_chunks(words: Words, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """Every row's number with the first row, row offsets, terms and counts of its chunk."""
    for lo, hi in row_slices(offsets, CHUNK_BYTES):
        found = words(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        for i in range(lo, hi):
            yield i, lo, *found


class Voter:
    """Votes of the nearest examples, rebuilt in a task from a model's arrays."""

    def __init__(self, arrays: dict):
        self.words, self.idf, self.labels = Words(arrays["vocabulary"]), arrays["idf"], arrays["labels"]
        self.index = BlockMaxIndex(arrays["first"], arrays["term"], arrays["weight"], len(self.idf), int(self.labels.sum()))
        self.memo: dict = {}

    def vote(self, terms: np.ndarray, weights: np.ndarray, told: np.ndarray, without: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """Votes for label 1 less those for 0, as a part of all similarity:
        each example found votes with the part of its cosine that comes from
        terms that tell of the label. Also the examples and their cosines."""
        norm = np.sqrt(weights @ weights)
        q = weights / norm if norm > 0 else weights
        found, near, votes = self.index.search(terms, q, told[terms], NEIGHBOURS, without)
        if not len(found):
            return 0.0, found, near
        return float(np.round((votes * (2.0 * self.labels[found] - 1)).sum() / near.sum(), 9)), found, near


def voter(arrays: dict) -> Voter:
    """The voter of a model, kept by the Python worker for later tasks."""
    return held(arrays["key"], lambda: Voter(arrays))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> dict:
    """Learn from the labelled documents for which ``learn`` holds. The model
    is a dict of arrays, a few MB.

    About ``toxic_rows`` and ``clean_rows`` of them are the examples; their
    words are the vocabulary. A term weighs its IDF over all documents,
    whatever its labels. Labels enter the votes only: how much a term tells is
    counted over all labelled documents (about a million of them at most) in
    four parts, and each example is calibrated, without itself, by what the
    other three parts tell.
    """
    marked = (labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    sizes = marked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    n_clean = sizes.n - sizes.toxic
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")
    sample = F.broadcast(marked.where(hash_below(F.col("doc_id"), "labels", LABEL_ROWS, sizes.n)).select("doc_id", "toxic", fold))
    chosen = F.broadcast(marked.where(hash_below(F.col("doc_id"), "examples", toxic_rows, sizes.toxic) & (F.col("toxic") == 1)
                                      | hash_below(F.col("doc_id"), "examples", clean_rows, n_clean) & (F.col("toxic") == 0))
                         .select("doc_id", "toxic", fold))
    bound_batches(docs.sparkSession)
    text = docs.select("doc_id", text_column(docs).alias("text"))

    def vectors(batches):
        hasher = WordHasher()
        for batch in batches:
            raw, offsets = utf8_buffers(batch.column(3))
            terms, counts = [], []
            for i in range(batch.num_rows):
                words = [hasher(part, own)[0] for _, part, own in text_parts(raw[offsets[i]:offsets[i + 1]], offsets[i:i + 2] - offsets[i], hasher.fold != 0, CHUNK_BYTES)]
                t, n = np.unique(np.concatenate(words) if words else np.zeros(0, np.uint64), return_counts=True)
                terms.append(t.view(np.int64))
                counts.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(terms, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32()))],
                                             names=["doc_id", "toxic", "fold", "terms", "counts"])

    # of rows that repeat an id, one text is the example
    one = text.join(chosen, "doc_id").groupBy(F.col("doc_id").cast("long").alias("doc_id"), "toxic", "fold").agg(F.min("text").alias("text"))
    found = land(one.mapInArrow(lean(vectors), "doc_id long, toxic int, fold int, terms array<long>, counts array<int>"), "examples")
    examples = found.where(F.size("terms") > 0).toArrow()  # at most about toxic_rows + clean_rows
    ids, toxic, folds = (examples[c].to_numpy().copy() for c in ("doc_id", "toxic", "fold"))
    lists, counts = examples["terms"].combine_chunks(), examples["counts"].combine_chunks().flatten().to_numpy()
    hashes, size = lists.flatten().to_numpy().view(np.uint64), np.diff(lists.offsets.to_numpy()).astype(np.int64)
    vocabulary, term = np.unique(hashes, return_inverse=True)
    del examples, lists, hashes
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count_terms(batches):
        words = Words(known.value)
        n_terms = len(known.value)
        # documents, then labelled rows and toxic rows of each part; the last term counts texts
        table = np.zeros((1 + 2 * FOLDS, n_terms + 1), np.int64)
        for batch in batches:
            raw, offsets = utf8_buffers(batch.column(0))
            toxic_of, fold_of = (np.asarray(batch.column(i).fill_null(-1)) for i in (1, 2))
            for lo, hi in row_slices(offsets, CHUNK_BYTES):
                rows, found, _ = words(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                own, part, y = np.diff(rows), fold_of[lo:hi], toxic_of[lo:hi]
                groups = [(0, part > -2), *[(1 + f, part == f) for f in range(FOLDS)], *[(1 + FOLDS + f, (part == f) & (y == 1)) for f in range(FOLDS)]]
                for g, some in groups:
                    if some.any():
                        np.add.at(table[g], found[np.repeat(some, own)], 1)
                        table[g, n_terms] += some.sum()
        used = np.flatnonzero(table[0])
        for lo in range(0, len(used), 100_000):
            at = used[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *[pa.array(row[at]) for row in table]], names=columns)

    columns = ["term", "df", *[f"n{f}" for f in range(FOLDS)], *[f"hits{f}" for f in range(FOLDS)]]
    counted = text.join(sample, "doc_id", "left").select("text", "toxic", "fold").mapInArrow(lean(count_terms), ", ".join(f"{c} long" for c in columns))
    totals = counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in columns[1:]]).toArrow()  # a row for each word of the vocabulary
    table = np.zeros((len(columns) - 1, len(vocabulary) + 1))
    table[:, totals["term"].to_numpy()] = np.array([totals[c].to_numpy() for c in columns[1:]], float)
    df, rows, hits = table[0], table[1:1 + FOLDS], table[1 + FOLDS:]
    base = hits[:, -1].sum() / max(1, rows[:, -1].sum())
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1e-3).astype(np.float32)
    told = reliability(hits.sum(0)[:-1], rows.sum(0)[:-1], base)

    first = np.cumsum(size) - size
    weight = (1 + np.log(counts)) * idf[term]
    if len(ids):
        weight /= np.repeat(np.maximum(np.sqrt(np.add.reduceat(weight * weight, first)), 1e-300), size)
        at_top = np.flatnonzero(weight == np.repeat(np.maximum.reduceat(weight, first), size))
        strongest = term[at_top[np.searchsorted(at_top, first)]]
        order = np.lexsort((ids, strongest, -toxic))  # toxic ones first; alike examples share blocks
        place = spans(first[order], size[order])
        first, term, weight = np.concatenate([[0], np.cumsum(size[order])]), term[place], weight[place]
        ids, toxic, folds = ids[order], toxic[order], folds[order]
    else:
        first = np.zeros(1, np.int64)
    model = {"key": uuid.uuid4().hex, "vocabulary": vocabulary, "idf": idf, "told": told, "base": float(base),
             "share": ((hits.sum(0)[:-1] + TERM_PRIOR * base) / (rows.sum(0)[:-1] + TERM_PRIOR)).astype(np.float32),
             "first": first, "term": term.astype(np.int32), "weight": weight.astype(np.float32), "labels": toxic.astype(np.int8), "ids": ids}
    others = [reliability(hits.sum(0)[:-1] - hits[f, :-1], rows.sum(0)[:-1] - rows[f, :-1], base) for f in range(FOLDS)]
    shared = docs.sparkSession.sparkContext.broadcast((model, others, folds))

    def calibrate(batches):
        arrays, told_by_others, fold_of = shared.value
        v, first_ = voter(arrays), arrays["first"]
        for batch in batches:
            at = batch.column(0).to_numpy()
            raw = [v.vote(v.index.term[first_[e]:first_[e + 1]], v.index.weight[first_[e]:first_[e + 1]].astype(float), told_by_others[fold_of[e]], e)[0]
                   for e in at]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw, pa.float64())], names=["example", "raw"])

    at, rate = np.array([-1.0, 1.0]), np.array([base, base])
    if len(ids):
        tasks = max(1, min(len(ids) // 100, docs.sparkSession.sparkContext.defaultParallelism))
        tried = docs.sparkSession.range(len(ids), numPartitions=tasks).mapInArrow(calibrate, "example long, raw double").toArrow()
        weights = np.where(toxic == 1, max(1.0, sizes.toxic / max(1, toxic.sum())), max(1.0, n_clean / max(1, (1 - toxic).sum())))
        e = tried["example"].to_numpy()
        at, rate = isotonic(tried["raw"].to_numpy(), toxic[e].astype(float), weights[e])
    shared.unpersist()
    known.unpersist()
    return model | {"at": at, "rate": rate}


def score(docs: DataFrame, model: dict, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Score every whole text: a struct of ``score`` (0 to 1), ``predicted``
    (1 from 0.7 on), the ``terms`` found that mostly toxic rows hold, and the
    nearest examples (up to two of each label) as ``evidence``.

    Defined cases: a null or empty text, or one without any example's word,
    scores the rate of toxic rows; without labels every score is 0; equal
    similarities go to the earlier example; of conflicting labels the higher
    holds; repeated rows score alike; a very long text is read in parts of half a
    megabyte, cut between words; other columns, also of clashing names, are carried
    as they are. Returns the frame and the struct's name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        arrays = shared.value
        v, told, share, at, rate, base = voter(arrays), *(arrays[c] for c in ("told", "share", "at", "rate", "base"))

        def one(terms, counts):
            raw, found, near = v.vote(terms, (1 + np.log(counts)) * v.idf[terms], told)
            if not len(found):
                return base, []
            best = np.lexsort((found, -near))
            split = [[i for i in best if arrays["labels"][found[i]] == y][:2] for y in (1, 0)]
            evidence = [{"doc_id": int(arrays["ids"][found[i]]), "similarity": float(near[i]), "toxic": int(arrays["labels"][found[i]])}
                        for i in sorted(split[0] + split[1], key=lambda i: (-near[i], found[i]))]
            return float(np.clip(0.999 * np.interp(raw, at, rate) + 0.0005 * (raw + 1), 0, 1)), evidence

        def step(raw, offsets, nulls, batch):
            scores, marks, evidence = [], [], []
            for i, lo, rows, terms, counts in in_chunks(v.words, raw, offsets):
                t, n = terms[rows[i - lo]:rows[i - lo + 1]], counts[rows[i - lo]:rows[i - lo + 1]]
                key = (t.tobytes(), n.tobytes())
                if key not in v.memo:
                    if len(v.memo) >= 1000:
                        v.memo.clear()
                    v.memo[key] = one(t, n)
                s, near = v.memo[key]
                scores.append(s)
                evidence.append(near)
                marks.append(v.words.named(raw[offsets[i]:offsets[i + 1]], t[share[t] > 0.5]))
            kind = pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())])
            return [pa.array(scores, pa.float64()), pa.array([int(s >= REJECT) for s in scores], pa.int32()),
                    pa.array(marks, pa.list_(pa.string())), pa.array(evidence, pa.list_(kind))]

        return step

    return annotate(docs, "toxicity", RESULT, make, keep)
