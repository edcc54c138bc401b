"""Language identification: a bidirectional gated recurrent network over bytes,
trained in numpy by backpropagation through time."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdscope.llm.common import annotate, land, row_slices, ship, text_column

#: Training rows of each language, and characters taken from each at a hashed place.
LEARN_ROWS, LEARN_CHARS = 500, 512
#: State of one direction; bytes that a state runs over before it starts anew.
HIDDEN, WINDOW = 8, 128
STEPS, BATCH, RATE = 160, 192, 0.03
#: Most languages whose hash bounds are broadcast (two numbers each).
BROADCAST_LANGS = 10_000
#: Windows that run through the network together.
TOGETHER = 4096

RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("shares", T.MapType(T.StringType(), T.DoubleType()))])


@dataclass
class Direction:
    """One gated recurrent layer. ``look`` holds the input part of the update,
    reset and candidate gates for each byte, ``turn`` the recurrent weights."""

    look: np.ndarray
    turn: np.ndarray
    bias: np.ndarray

    def run(self, steps: np.ndarray, keep: bool = False):
        """States after each step of ``steps`` (time, windows) of byte values."""
        time, n = steps.shape
        h = np.zeros((n, HIDDEN), np.float32)
        states = np.empty((time, n, HIDDEN), np.float32)
        kept = []
        for t in range(time):
            x = self.look[steps[t]]
            u = h @ self.turn
            gates = x[:, :2 * HIDDEN] + u[:, :2 * HIDDEN]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            back = u[:, 2 * HIDDEN:] + self.bias
            c = r * back
            c += x[:, 2 * HIDDEN:]
            np.tanh(c, out=c)
            new = c + z * (h - c)
            if keep:
                kept.append((h, z, r, back, c))
            states[t] = h = new
        return (states, kept) if keep else states

    def learn(self, steps: np.ndarray, kept: list, d_states: np.ndarray) -> list[np.ndarray]:
        """Gradients of the three weight arrays, back through all steps."""
        g_look, g_turn, g_bias = (np.zeros_like(w) for w in (self.look, self.turn, self.bias))
        d_next = np.zeros_like(d_states[0])
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, back, c = kept[t]
            d = d_states[t] + d_next
            d_c = d * (1 - z) * (1 - c * c)
            d_z = d * (h - c) * z * (1 - z)
            d_r = d_c * back * r * (1 - r)
            d_back = d_c * r
            d_u = np.hstack([d_z, d_r, d_back])
            np.add.at(g_look, steps[t], np.hstack([d_z, d_r, d_c]))
            g_turn += h.T @ d_u
            g_bias += d_back.sum(axis=0)
            d_next = d * z + d_u @ self.turn.T
        return [g_look, g_turn, g_bias]


def cut_windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of all rows as (WINDOW, windows) byte values, each window's
    length and its row. Places past a window's length hold 0."""
    sizes = np.diff(offsets)
    per_row = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), per_row)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    start = offsets[row] + nth * WINDOW
    length = np.minimum(WINDOW, offsets[row + 1] - start)
    at = start[None, :] + np.arange(WINDOW)[:, None]
    inside = np.arange(WINDOW)[:, None] < length[None, :]
    padded = np.append(raw, np.uint8(0))
    return np.where(inside, padded[np.minimum(at, len(raw))], 0).astype(np.uint8), length, row


@dataclass
class Network:
    langs: list[str]
    ahead: Direction
    behind: Direction
    out: np.ndarray
    out_bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.look, self.ahead.turn, self.ahead.bias, self.behind.look, self.behind.turn, self.behind.bias,
                self.out, self.out_bias]

    @staticmethod
    def chances(logits: np.ndarray) -> np.ndarray:
        e = np.exp(logits - logits.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def positions(self, steps: np.ndarray) -> np.ndarray:
        """(time, windows, languages) probabilities of each byte's label."""
        a, b = self.ahead.run(steps), self.behind.run(steps[::-1])[::-1]
        return self.chances(a @ self.out[:HIDDEN] + b @ self.out[HIDDEN:] + self.out_bias)

    def documents(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the mean probability of each language over its bytes,
        and the share of bytes that each language labels."""
        rows = len(offsets) - 1
        pooled, labelled = np.zeros((rows, len(self.langs))), np.zeros((rows, len(self.langs)))
        for i, j in row_slices(offsets, 1 << 21):
            steps, length, row = cut_windows(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            for lo in range(0, len(row), TOGETHER):
                part = slice(lo, lo + TOGETHER)
                p = self.positions(steps[:, part])
                inside = (np.arange(WINDOW)[:, None] < length[None, part]).astype(np.float32)
                np.add.at(pooled, i + row[part], np.einsum("twl,tw->wl", p, inside))
                best = p == p.max(axis=-1, keepdims=True)
                np.add.at(labelled, i + row[part], np.einsum("twl,tw->wl", best.astype(np.float32), inside))
        n = np.maximum(np.diff(offsets), 1)[:, None]
        return pooled / n, labelled / np.maximum(labelled.sum(axis=1, keepdims=True), 1)


def train(samples: list[tuple[str, str]], seed: int = 7) -> Network | None:
    """Fit the network to (language, text) samples; every byte of a window is
    labelled with its text's language."""
    langs = sorted({lang for lang, text in samples if text})
    if not langs:
        return None
    rng = np.random.default_rng(seed)

    def start(*shape):
        return (rng.standard_normal(shape) * 0.3).astype(np.float32)

    def direction():
        return Direction(start(256, 3 * HIDDEN), start(HIDDEN, 3 * HIDDEN), np.zeros(HIDDEN, np.float32))

    net = Network(langs, direction(), direction(), start(2 * HIDDEN, len(langs)), np.zeros(len(langs), np.float32))
    groups = [[t.encode() for lang, t in samples if lang == x and t] for x in langs]
    first, second = [np.zeros_like(w) for w in net.weights()], [np.zeros_like(w) for w in net.weights()]
    for step in range(1, STEPS + 1):
        label = rng.integers(0, len(langs), BATCH)
        texts = []
        for k in label:
            text = groups[k][rng.integers(len(groups[k]))]
            at = rng.integers(0, max(1, len(text) - WINDOW // 4))
            texts.append(text[at:at + (WINDOW if rng.random() < 0.8 else rng.integers(8, WINDOW))])
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        steps, length, row = cut_windows(np.frombuffer(b"".join(texts), np.uint8), offsets)
        inside = np.arange(WINDOW)[:, None] < length[None, :]
        a, kept_a = net.ahead.run(steps, True)
        b, kept_b = net.behind.run(steps[::-1], True)
        both = np.concatenate([a, b[::-1]], axis=-1)
        error = net.chances(both @ net.out + net.out_bias)
        error[:, np.arange(len(row)), label[row]] -= 1
        error *= (inside / max(1, inside.sum()))[:, :, None]
        error = error.astype(np.float32)
        d_both = error @ net.out.T
        grads = [*net.ahead.learn(steps, kept_a, d_both[..., :HIDDEN]),
                 *net.behind.learn(steps[::-1], kept_b, d_both[::-1, :, HIDDEN:]),
                 np.einsum("twh,twl->hl", both, error), error.sum(axis=(0, 1))]
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for w, g, m, v in zip(net.weights(), grads, first, second):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, learn: Column, rows: int = LEARN_ROWS, chars: int = LEARN_CHARS) -> Network | None:
    """Train on up to ``rows`` distinct rows of each language (the first by a
    hash) for which ``learn`` holds, ``chars`` characters from a hashed place of
    each. Only rows whose hash lies below a bound that about twice as many
    reach are ranked, so no language is ranked as a whole."""
    text = text_column(docs)
    pick = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("place")), F.greatest(F.length(text) - chars + 1, F.lit(1)))
    able = (docs.where(learn & F.col("lang").isNotNull() & (F.length(text) > 0))
            .select(F.col("lang").cast("string").alias("lang"), pick.alias("pick"),
                    F.substring(text, (place + 1).cast("int"), F.lit(chars)).alias("part")))
    sizes = able.groupBy("lang").agg(F.approx_count_distinct("pick").alias("_n"))
    least = F.lit(-2.0 ** 63) + F.lit(2.0 ** 65 * rows) / F.col("_n")
    bounds = land(sizes.select(F.col("lang").alias("_lang"), F.when(F.col("_n") > 2 * rows, least.cast("long"))
                               .otherwise(F.lit((1 << 63) - 1)).alias("_bound")), "language-bounds")
    few = F.broadcast(bounds) if bounds.count() <= BROADCAST_LANGS else bounds
    near = able.join(few, (F.col("lang") == F.col("_lang")) & (F.col("pick") <= F.col("_bound"))).select("lang", "pick", "part").distinct()
    order = Window.partitionBy("lang").orderBy("pick", "part")
    chosen = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= rows)
    return train(sorted((r.lang, r.part) for r in chosen.select("lang", "part").collect()))


def identify(docs: DataFrame, net: Network | None, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Predict the language of every whole text: a struct of ``lang_pred``, its
    mean probability over all bytes as ``score``, and ``shares``, the part of
    the bytes labelled with each language.

    Defined cases: a null text, or one without any letter, is ``und`` with
    score 0, as is every text if there was nothing to learn from; repeated
    rows get the same; equal probabilities go to the first language in
    alphabetical order; other columns, also of clashing names, are carried as
    they are. Returns the frame and the struct's name.
    """
    shared = ship(docs.sparkSession, net)

    def make():
        model: Network | None = pickle.loads(shared.value)
        letter = np.zeros(256, bool)
        letter[65:91] = letter[97:123] = True

        def step(raw, offsets, nulls, batch):
            n = len(offsets) - 1
            marks = np.concatenate([[0], np.cumsum(letter[raw])])
            plain = marks[offsets[1:]] > marks[offsets[:-1]]
            data = raw.tobytes()
            known = [bool(plain[i]) or any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].decode()) for i in range(n)]
            if model is None:
                known = [False] * n
                pooled = labelled = np.zeros((n, 0))
            else:
                pooled, labelled = model.documents(raw, offsets)
            best = pooled.argmax(axis=1) if pooled.shape[1] else np.zeros(n, int)
            pred = [model.langs[best[i]] if known[i] else "und" for i in range(n)]
            score = [float(np.clip(pooled[i, best[i]], 0, 1)) if known[i] else 0.0 for i in range(n)]
            shares = [list(zip(model.langs, labelled[i].tolist())) if known[i] else [] for i in range(n)]
            return [pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                    pa.array(shares, pa.map_(pa.string(), pa.float64()))]

        return step

    return annotate(docs, "language", RESULT, make, keep)
