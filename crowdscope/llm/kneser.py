"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of
trusted text, and language-specific perplexity thresholds."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdscope.llm.common import annotate, bound_batches, free_name, held, land, lean, row_slices, text_column, utf8_buffers

#: Bytes of an n-gram.
ORDER = 5
#: N-grams of one scoring table: 48 MB as sorted codes and logarithms.
SHARD_GRAMS = 4_000_000
#: N-grams counted by a task before it passes partial counts on (32 MB), and rows of one batch of these.
HELD_GRAMS, GRAM_ROWS = 2_000_000, 100_000
#: N-grams put into a scoring table at once.
INSERT_GRAMS = 1 << 18
#: Most trusted ids that are broadcast (8 MB); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Most languages whose discounts are broadcast (a few doubles each).
BROADCAST_LANGS = 10_000
#: Trusted documents of one in so many only set thresholds, so that these are not met by text the model has seen.
THRESHOLD_FOLD = 4
#: A limit on log perplexity is this quantile of held-back trusted texts.
QUANTILE = 0.995
#: Bytes from which a text is in the next length band. Short clean texts spread
#: widely, so long ones have a limit of their own.
BANDS = (256, 1024)
#: Text bytes scored at once.
SCORE_BYTES = 1 << 18
#: A band of a language with fewer held-back texts takes the language's limit.
BAND_ROWS = 50
#: A text counts as if it had so many more bytes of its language's median, as the mean of a few bytes says little.
SHRINK = 100

RESULT = T.StructType([T.StructField("log_perplexity", T.DoubleType()), T.StructField("n_grams", T.LongType())])


def language(df: DataFrame) -> Column:
    return F.coalesce(df["lang"].cast("string"), F.lit("und"))


def gram_codes(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One code per byte of each row: the byte and the ORDER - 1 before it, with
    line feeds before the row's start."""
    n, rows, lead = len(raw), len(offsets) - 1, ORDER - 1
    sizes = np.diff(offsets)
    padded = np.full(n + rows * lead, 10, np.uint8)
    at = np.arange(n) + np.repeat(np.arange(1, rows + 1) * lead, sizes)
    padded[at] = raw
    codes = np.zeros(n, np.uint64)
    for back in range(ORDER):
        codes |= padded[at - back].astype(np.uint64) << np.uint64(8 * back)
    return codes


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) partial counts: one row per n-gram and language, more
    for a task that meets over about half of ``HELD_GRAMS`` n-grams."""

    def merged(found):
        codes, n = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(codes)
        codes, n = codes[order], n[order]
        at = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        return codes[at], np.add.reduceat(n, at)

    def passed_on(counted):
        for lang, found in counted.items():
            codes, n = merged(found)
            for lo in range(0, len(codes), GRAM_ROWS):
                grams = codes[lo:lo + GRAM_ROWS].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams),
                                                  pa.array(n[lo:lo + GRAM_ROWS])], names=["lang", "gram", "n"])

    def run(batches):
        counted: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for lang in sorted(set(langs)):
                part = batch.filter(pa.array(langs == lang))
                raw, offsets = utf8_buffers(part.column(0))
                for i, j in row_slices(offsets):
                    codes, n = np.unique(gram_codes(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]), return_counts=True)
                    if not len(codes):
                        continue
                    counted.setdefault(lang, []).append((codes, n.astype(np.int64)))
                    waiting += len(codes)
                    if waiting > HELD_GRAMS:
                        counted = {k: [merged(found)] for k, found in counted.items()}
                        waiting = sum(len(found[0][0]) for found in counted.values())
                        if waiting > HELD_GRAMS // 2:
                            yield from passed_on(counted)
                            counted, waiting = {}, 0
        yield from passed_on(counted)

    bound_batches(docs.sparkSession)
    return docs.select(text_column(docs).alias("text"), language(docs).alias("lang")).mapInArrow(
        lean(run), "lang string, gram long, n long")


def levels(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: its n-grams with discounted counts, and its
    contexts with their total and the weight they leave to the order below.

    The highest order has occurrence counts; a lower one counts the distinct
    bytes that precede an n-gram. The three discounts of each language and
    order come from its counts of counts.
    """
    out = []
    grams = counts
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            mask = (1 << (8 * order)) - 1
            grams = grams.groupBy("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        grams = land(grams, f"grams-{order}")
        kinds = grams.groupBy("lang").agg(*[F.sum(F.when(F.col("n") == k, 1).otherwise(0)).alias(f"n{k}") for k in (1, 2, 3, 4)])
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        cuts = kinds.select("lang", *[
            F.when((F.col(f"n{k}") > 0) & (F.col("n1") > 0),
                   F.least(F.greatest(k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"), F.lit(0.05)), F.lit(k - 0.05)))
            .otherwise(F.lit(0.5 * k)).alias(f"d{k}") for k in (1, 2, 3)])
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        cuts = land(cuts, f"discounts-{order}")
        known = grams.join(F.broadcast(cuts) if cuts.count() <= BROADCAST_LANGS else cuts, "lang").select("lang", "gram", "n", (F.col("n") - cut).alias("kept"), cut.alias("cut"))
        contexts = known.groupBy("lang", F.shiftright("gram", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.sum("cut").alias("left"))
        out.append((known.select("lang", "gram", "kept"), contexts))
    return out[::-1]


def probabilities(asked: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(lang, gram, log probability of the gram's last byte) of each n-gram
    asked for, by joins with the count tables from order 1 up. Each order
    answers only for the distinct endings that the order above asks for."""
    wanted = [asked]
    for order in range(ORDER - 1, 0, -1):
        ending = F.col("gram").bitwiseAND(F.lit((1 << (8 * order)) - 1)).alias("gram")
        wanted.append(land(wanted[-1].select("lang", ending).distinct(), f"asked-{order}"))
    below = None
    for order, ((known, contexts), grams) in enumerate(zip(tables, wanted[::-1]), 1):
        out = grams.join(known, ["lang", "gram"], "left").withColumn("_context", F.shiftright("gram", 8))
        out = out.join(contexts.withColumnRenamed("context", "_context"), ["lang", "_context"], "left")
        if below is None:
            out = out.withColumn("p", F.lit(1.0 / 256))
        else:
            ending = F.col("gram").bitwiseAND(F.lit((1 << (8 * (order - 1))) - 1))
            out = out.withColumn("_ending", ending).join(below.select("lang", F.col("gram").alias("_ending"), "p"), ["lang", "_ending"])
        mixed = (F.coalesce("kept", F.lit(0.0)) + F.col("left") * F.col("p")) / F.col("total")
        below = out.select("lang", "gram", F.when(F.col("total").isNull(), F.col("p")).otherwise(mixed).alias("p"))
        if order < ORDER:
            below = land(below, f"chances-{order}")
    return below.select("lang", "gram", F.log("p").cast("float").alias("logp"))


class GramTable:
    """Vectorised open-addressing lookup of 64-bit codes."""

    STEP = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        bits = max(4, (4 * len(codes) // 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.codes = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.zeros(1 << bits, np.float32)
        for lo in range(0, len(codes), INSERT_GRAMS):
            self.insert(codes[lo:lo + INSERT_GRAMS], values[lo:lo + INSERT_GRAMS])

    def insert(self, codes: np.ndarray, values: np.ndarray) -> None:
        left = np.arange(len(codes))
        slot = self.slot(codes)
        while len(left):
            free = self.codes[slot[left]] == np.uint64(0xFFFFFFFFFFFFFFFF)
            takers = left[free]
            self.codes[slot[takers]] = codes[takers]
            won = left[self.codes[slot[left]] == codes[left]]
            self.values[slot[won]] = values[won]
            left = left[self.codes[slot[left]] != codes[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * self.STEP) >> self.shift).astype(np.int64)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """The values; 0 for a code that is not in this table."""
        slot = self.slot(codes)
        found = self.codes[slot]
        out = np.where(found == codes, self.values[slot], np.float32(0))
        left = np.flatnonzero((found != codes) & (found != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            found = self.codes[slot[left]]
            hit = found == codes[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (found != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out


class QualityModel:
    """Log probabilities of all n-grams of a corpus, in shards by a hash."""

    def __init__(self, scored: DataFrame, shard_grams: int = SHARD_GRAMS):
        spark = scored.sparkSession
        self.langs = {r.lang: i for i, r in enumerate(scored.select("lang").distinct().orderBy("lang").collect())}
        self.shards, self.key = [], uuid.uuid4().hex
        n = max(1, -(-scored.count() // shard_grams))
        for k in range(n):  # each shard's size is bounded; one at a time passes the driver
            part = scored.where(F.pmod(F.xxhash64("lang", "gram"), F.lit(n)) == k).toArrow()
            ids = np.array([self.langs[x] for x in part["lang"].to_pylist()], np.uint64) if part.num_rows else np.zeros(0, np.uint64)
            codes = part["gram"].to_numpy().astype(np.uint64) | (ids << np.uint64(8 * ORDER))
            self.shards.append(spark.sparkContext.broadcast((codes, part["logp"].to_numpy().astype(np.float32))))

    def annotate(self, docs: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, str]:
        langs, shards, key = self.langs, self.shards, self.key
        hidden = "lang__"
        while hidden in docs.columns:
            hidden += "_"
        kept = docs.columns if keep is None else keep
        docs = docs.withColumn(hidden, language(docs))

        def build():
            tables = []
            for s in shards:
                tables.append(GramTable(*s.value))
                vars(s).pop("_value", None)  # the table is the only copy; the broadcast's file could be read again
            return tables

        def make():
            tables = held(key, build)

            def step(raw, offsets, nulls, batch):
                at = batch.schema.get_field_index(hidden)
                ids = np.array([langs.get(x, len(langs)) for x in batch.column(at).to_pylist()], np.uint64)
                sums = np.zeros(len(ids))
                for i, j in row_slices(offsets, SCORE_BYTES):
                    own = offsets[i:j + 1] - offsets[i]
                    codes = gram_codes(raw[offsets[i]:offsets[j]], own)
                    codes |= np.repeat(ids[i:j] << np.uint64(8 * ORDER), np.diff(own))
                    total = sum(t(codes) for t in tables)
                    running = np.concatenate([[0.0], np.cumsum(total, dtype=float)])
                    sums[i:j] = running[own[1:]] - running[own[:-1]]
                n = np.diff(offsets)
                ok = n > 0
                mean = np.where(ok, -sums / np.maximum(n, 1), 0.0)
                return [pa.array(mean, pa.float64(), mask=~ok), pa.array(n, pa.int64())]

            return step

        out, name = annotate(docs, "language_model", RESULT, make, [*kept, hidden])
        return out.drop(hidden), name


def trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents labelled as good quality (of conflicting labels the higher holds)."""
    good = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("_q")).where("_q = 1").drop("_q")
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    return docs.join(good, "doc_id", "left_semi")


def fit(docs: DataFrame, labels: DataFrame, shard_grams: int = SHARD_GRAMS) -> tuple[QualityModel, DataFrame]:
    """Train on the trusted documents and return the model, which can score
    ``docs``, and the limits: (lang, band, median, limit) on log perplexity."""
    trusted = trusted_rows(docs.select("doc_id", "text", "lang"), labels)
    fold = F.pmod(F.xxhash64("doc_id", F.lit("threshold")), F.lit(THRESHOLD_FOLD))
    counts = count_grams(trusted.where(fold != 0)).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    asked = land(count_grams(docs).select("lang", "gram").distinct(), "asked")
    model = QualityModel(land(probabilities(asked, levels(counts)), "gram-probabilities"), shard_grams)
    held, name = model.annotate(trusted.where(fold == 0), ["lang"])
    held = land(held.select(language(held).alias("lang"), f"{name}.*").where("n_grams > 0"), "held-perplexity")
    middle = held.groupBy("lang").agg(F.percentile_approx("log_perplexity", 0.5, F.lit(10_000)).alias("median"))
    value = shrunk(F.col("log_perplexity"), F.col("n_grams"), F.col("median"))
    scored = land(held.join(middle, "lang").select("lang", "median", band(F.col("n_grams")).alias("band"), value.alias("value")), "held-values")
    top = F.percentile_approx("value", QUANTILE, F.lit(10_000))
    own = scored.groupBy("lang", "band").agg(top.alias("_own"), F.count(F.lit(1)).alias("_n"))
    whole = scored.groupBy("lang", "median").agg(top.alias("_whole"))
    every = whole.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(len(BANDS)))))
    limits = every.join(own, ["lang", "band"], "left").select(
        "lang", "band", "median", F.when(F.col("_n") >= BAND_ROWS, F.col("_own")).otherwise(F.col("_whole")).alias("limit"))
    return model, land(limits, "quality-limits")


def shrunk(log_perplexity: Column, n: Column, median: Column) -> Column:
    return (log_perplexity * n + SHRINK * median) / (n + SHRINK)


def band(n: Column) -> Column:
    """The length band of a text of ``n`` bytes, from 0."""
    return sum((n >= edge).cast("int") for edge in BANDS)


def judge(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None,
          shard_grams: int = SHARD_GRAMS) -> tuple[DataFrame, str]:
    """Perplexity of every whole text under its language's model, and whether
    it stays within the limit of its language and length: a struct of
    log_perplexity, n_grams, limit and good.

    Defined cases: a null or empty text has no perplexity and is good (nothing
    speaks against it); a null lang is the language ``und``; a language without
    trusted text has no limit, so its documents are good; an empty table gives
    no rows; repeated rows are judged alike; other columns, also of clashing
    names, are carried as they are. Returns the frame and the struct's name.
    """
    model, limits = fit(docs, labels, shard_grams)
    out, name = model.annotate(docs, keep if keep is None else [*keep, *({"lang"} - set(keep))])
    own = {c: free_name(out, f"_{c}") for c in ("lang", "band", "median", "limit")}
    flat = limits.select(*[F.col(c).alias(own[c]) for c in own])
    value, n = F.col(f"{name}.log_perplexity"), F.col(f"{name}.n_grams")
    joined = out.join(F.broadcast(flat) if flat.count() <= BROADCAST_LANGS else flat,
                      (language(out) == F.col(own["lang"])) & (band(n) == F.col(own["band"])), "left")
    good = F.coalesce(shrunk(value, n, F.col(own["median"])) <= F.col(own["limit"]), F.lit(True))
    verdict = F.struct(value, n, F.col(own["limit"]).alias("limit"), good.alias("good"))
    columns = docs.columns if keep is None else keep
    return joined.select(*columns, verdict.alias(name)), name
