"""Toxicity: a bidirectional gated recurrent network with attention pooling over overlapping windows of words.

Each word enters as the embedding of its hashed form and the average embedding of its hashed character n-grams.
Two gated recurrent layers read a window in both directions, attention pools their states, and a linear unit gives
the window's logit. A document has the largest logit of all its windows, calibrated to a probability.

Training is in numpy on a bounded sample of labelled documents. Labels are of documents, windows have none: first
each document is represented by the window with the most telling word, later by the window that the network finds
most toxic. Embeddings start at zero, so what training has not seen is neutral.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlayers.llm.common import WordTable, chunks, fold_of, hash_words, id_and_text, lean_worker, row_schema, text_bytes

#: Labelled documents in the training sample (half of them toxic where there are enough): the driver gets no more.
SAMPLE_ROWS = 3_000
#: Bytes of the longest text of the sample.
SAMPLE_TEXT = 1 << 16
WINDOW, STRIDE = 24, 12
HIDDEN, WIDTH = 6, 8
WORD_BUCKETS, CHAR_BUCKETS = 1 << 15, 1 << 13
BATCH, EPOCHS, RATE, DECAY = 128, 6, 0.01, 1e-5
#: Words of fewer sample documents have no embedding of their own.
LEAST_DOCUMENTS = 3
CHUNK_BYTES = 1 << 20


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


#: ASCII characters that are neither letters nor digits separate words.
_SPACED = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().translate(_SPACED).split()


def char_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of each marked word, one word after the other, and their numbers."""
    marked = [b"<" + w + b">" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    code = (data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:]
    inside = owner[:-2] == owner[2:]
    code = code[inside] * np.uint64(0x9E3779B97F4A7C15)
    return (code >> np.uint64(40)).astype(np.int64) % CHAR_BUCKETS, np.bincount(owner[:-2][inside], minlength=len(words))


def window_starts(n: int) -> list[int]:
    """Starts of windows that overlap by half; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


@dataclass
class Network:
    weights: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    rare: set[bytes] = field(default_factory=set)

    @classmethod
    def new(cls, rng: np.random.Generator) -> Network:
        draw = lambda *s: rng.normal(0, 0.3, s).astype(np.float32)
        w = {"word": np.zeros((WORD_BUCKETS, WIDTH), np.float32), "char": np.zeros((CHAR_BUCKETS, WIDTH), np.float32)}
        for side in "fb":
            w |= {f"in_{side}": draw(2 * WIDTH, 3 * HIDDEN), f"u_{side}": draw(HIDDEN, 3 * HIDDEN),
                  f"bias_{side}": np.zeros(3 * HIDDEN, np.float32)}
        w |= {"attend": draw(2 * HIDDEN), "out": draw(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        return cls(w)

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """The word and character embeddings of each word, side by side."""
        w = self.weights
        bucket, many = char_buckets(words)
        sums = np.add.reduceat(w["char"][bucket], np.cumsum(many) - many, axis=0) if len(bucket) else np.zeros((len(words), WIDTH))
        own = w["word"][word_buckets(words)]
        if self.rare:
            own[[x in self.rare for x in words]] = 0
        return np.concatenate([own, sums / many[:, None]], axis=1).astype(np.float32)

    def projected(self, words: list[bytes]) -> np.ndarray:
        """What each word adds to the gates of both directions."""
        x, w = self.inputs(words), self.weights
        return np.concatenate([x @ w["in_f"] + w["bias_f"], x @ w["in_b"] + w["bias_b"]], axis=1).astype(np.float32)

    def run(self, x: np.ndarray, mask: np.ndarray | None, side: str, keep: list | None = None) -> np.ndarray:
        """States of one direction; x is (time, batch, gates). With `keep`, what the gradient needs is added to it."""
        u, h = self.weights[f"u_{side}"], np.zeros((x.shape[1], HIDDEN), np.float32)
        out = np.empty((*x.shape[:2], HIDDEN), np.float32)
        for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
            hu = h @ u
            zr = sigmoid(x[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[t, :, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            if mask is not None:
                new = np.where(mask[t][:, None], new, h)
            if keep is not None:
                keep.append((t, h, z, r, n, hu[:, 2 * HIDDEN :]))
            out[t] = h = new
        return out

    def pool(self, states: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Attention over time: weights, pooled states, logits."""
        energy = states @ self.weights["attend"]
        if mask is not None:
            energy = np.where(mask, energy, -1e9)
        a = np.exp(energy - energy.max(axis=0))
        if mask is not None:
            a = a * mask
        a /= np.maximum(a.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", a, states)
        return a, pooled, pooled @ self.weights["out"] + self.weights["bias"][0]

    def logits(self, rows: np.ndarray, ids: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        """Logits of windows: `ids` (time, batch) are places in `rows`, the projections of words."""
        x = rows[ids]
        states = np.concatenate([self.run(x[..., : 3 * HIDDEN], mask, "f"), self.run(x[..., 3 * HIDDEN :], mask, "b")], axis=2)
        return self.pool(states, mask)[2]

    def window_logits(self, texts: list[list[bytes]], table: WordTable) -> list[np.ndarray]:
        """The logits of all windows of each text; a text without words has one empty window."""
        ids = table.ids(texts)
        counts = [len(t) for t in texts]
        rows = table.rows if len(ids) else np.zeros((1, 6 * HIDDEN), np.float32)
        bases = np.cumsum([0, *counts])
        starts = [window_starts(n) for n in counts]
        out = [np.empty(len(s), np.float32) for s in starts]
        whole = [(k, j, bases[k] + s) for k, n in enumerate(counts) if n >= WINDOW for j, s in enumerate(starts[k])]
        for i in range(0, len(whole), 2048):
            some = whole[i : i + 2048]
            at = np.array([s for _, _, s in some])
            for (k, j, _), v in zip(some, self.logits(rows, ids[at[None] + np.arange(WINDOW)[:, None]], None)):
                out[k][j] = v
        short = [k for k, n in enumerate(counts) if n < WINDOW]
        for i in range(0, len(short), 2048):
            some = np.array(short[i : i + 2048])
            n, base = np.array(counts)[some], bases[some]
            time = np.arange(WINDOW)[:, None]
            mask = time < n
            own = ids[np.minimum(base + np.minimum(time, np.maximum(n - 1, 0)), len(ids) - 1)] if len(ids) else np.zeros(mask.shape, int)
            for k, v in zip(some, self.logits(rows, own, mask)):
                out[k][0] = v
        return out

    def probability(self, largest: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * largest.astype(np.float64) + self.shift)

    def gradients(self, ids: np.ndarray, mask: np.ndarray, y: np.ndarray, words: list[bytes], buckets: tuple) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over a batch of windows; `ids` are places in `words`."""
        w, g = self.weights, {}
        used, at = np.unique(ids, return_inverse=True)
        at = at.reshape(ids.shape)
        own, of_word, spread, many = buckets
        emb_word = w["word"][own[used]] * of_word[used][:, None]
        first = np.concatenate([[0], np.cumsum(many)])
        places = np.concatenate([np.arange(first[k], first[k + 1]) for k in used])
        n_chars = many[used]
        emb_char = np.add.reduceat(w["char"][spread[places]], np.cumsum(n_chars) - n_chars, axis=0) / n_chars[:, None]
        x_used = np.concatenate([emb_word, emb_char], axis=1).astype(np.float32)
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate(
            [self.run((x_used @ w[f"in_{s}"] + w[f"bias_{s}"])[at], mask, s, kept[s]) for s in "fb"], axis=2
        )
        a, pooled, logit = self.pool(states, mask)
        d_logit = ((sigmoid(logit) - y) / len(y)).astype(np.float32)
        g["bias"] = d_logit.sum(keepdims=True)
        g["out"] = pooled.T @ d_logit
        d_pooled = d_logit[:, None] * w["out"]
        d_a = np.einsum("tbh,bh->tb", states, d_pooled)
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        g["attend"] = np.einsum("tb,tbh->h", d_e, states)
        d_states = a[..., None] * d_pooled + d_e[..., None] * w["attend"]
        d_used = np.zeros((len(used), 2 * WIDTH), np.float32)
        for k, s in enumerate("fb"):
            u, d_u = w[f"u_{s}"], np.zeros_like(w[f"u_{s}"])
            d_x = np.zeros((*ids.shape, 3 * HIDDEN), np.float32)
            d_h = np.zeros((ids.shape[1], HIDDEN), np.float32)
            for t, h, z, r, n, hn in reversed(kept[s]):
                d = d_h + d_states[t, :, k * HIDDEN : (k + 1) * HIDDEN]
                m = mask[t][:, None]
                d_in = d * m
                d_n = d_in * (1 - z) * (1 - n * n)
                d_z = d_in * (h - n) * z * (1 - z)
                d_r = d_n * hn * r * (1 - r)
                d_hu = np.concatenate([d_z, d_r, d_n * r], axis=1)
                d_x[t] = np.concatenate([d_z, d_r, d_n], axis=1)
                d_u += h.T @ d_hu
                d_h = d * (1 - m) + d_in * z + d_hu @ u.T
            g[f"u_{s}"] = d_u
            by_word = np.zeros((len(used), 3 * HIDDEN), np.float32)
            np.add.at(by_word, at.reshape(-1), d_x.reshape(-1, 3 * HIDDEN))
            g[f"bias_{s}"] = by_word.sum(axis=0)
            g[f"in_{s}"] = x_used.T @ by_word
            d_used += by_word @ w[f"in_{s}"].T
        g["word"], g["char"] = np.zeros_like(w["word"]), np.zeros_like(w["char"])
        np.add.at(g["word"], own[used], d_used[:, :WIDTH] * of_word[used][:, None])
        np.add.at(g["char"], spread[places], np.repeat(d_used[:, WIDTH:] / n_chars[:, None], n_chars, axis=0))
        return g


def word_buckets(words: list[bytes]) -> np.ndarray:
    return (hash_words(words) >> np.uint64(30)).astype(np.int64) % WORD_BUCKETS


def telling(texts: list[list[bytes]], y: np.ndarray) -> dict[bytes, float]:
    """The smoothed log odds of toxicity of documents with each word that is not rare."""
    bad: Counter[bytes] = Counter()
    all_: Counter[bytes] = Counter()
    for t, toxic in zip(texts, y):
        kinds = set(t)
        all_.update(kinds)
        if toxic:
            bad.update(kinds)
    share = max(y.mean(), 1e-3)
    return {
        w: float(np.log((bad[w] + share) / (n - bad[w] + 1 - share)))
        for w, n in all_.items()
        if n >= LEAST_DOCUMENTS
    }


def train(texts: list[bytes], labels: list[int], prior: float, seed: int = 5) -> Network:
    """Fits the network; every fifth document is held back to calibrate it for the share `prior` of toxic ones."""
    rng = np.random.default_rng(seed)
    net = Network.new(rng)
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        net.scale, net.shift = 0.0, float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
        return net
    split = [words_of(t) for t in texts]
    fit = np.array([i for i in range(len(y)) if i % 5])
    held = np.array([i for i in range(len(y)) if not i % 5])
    odds = telling([split[i] for i in fit], y[fit])
    vocabulary: dict[bytes, int] = {b"": 0}
    coded = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in t] or [0]) for t in split]
    words = list(vocabulary)
    chars, many = char_buckets([w or b" " for w in words])
    buckets = (word_buckets(words), np.array([w in odds for w in words], np.float32), chars, many)
    net.rare = {w for w in words if w not in odds}
    weight = np.array([odds.get(w, -9.0) for w in words])

    def window(i: int, start: int) -> np.ndarray:
        return coded[i][start : start + WINDOW]

    def chosen(i: int) -> int:
        starts = window_starts(len(coded[i]))
        return max(starts, key=lambda s: weight[window(i, s)].max())

    best = {i: chosen(i) for i in fit}
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        if epoch >= EPOCHS // 2:
            table = WordTable(net.projected)
            for part in np.array_split(fit, max(1, len(fit) // 200)):
                for i, v in zip(part, net.window_logits([split[i] for i in part], table)):
                    best[i] = window_starts(len(coded[i]))[int(v.argmax())]
        items = [(i, best[i]) for i in fit]
        for i in fit:
            if not y[i]:
                starts = window_starts(len(coded[i]))
                items.append((i, starts[rng.integers(len(starts))]))
        for part in np.array_split(rng.permutation(len(items)), max(1, len(items) // BATCH)):
            some = [items[j] for j in part]
            ids, mask = np.zeros((WINDOW, len(some)), np.int64), np.zeros((WINDOW, len(some)), bool)
            for b, (i, start) in enumerate(some):
                own = window(i, start)
                ids[: len(own), b], mask[: len(own), b] = own, True
            step += 1
            for k, g in net.gradients(ids, mask, y[[i for i, _ in some]], words, buckets).items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.weights[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6) + DECAY * net.weights[k]
    largest = np.array([v.max() for v in net.window_logits([split[i] for i in held], WordTable(net.projected))])
    net.scale, net.shift = calibrate(largest, y[held], prior)
    return net


def calibrate(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with the classes weighted to the share that they have outside the sample."""
    n_bad, n_good = max(1.0, y.sum()), max(1.0, (1 - y).sum())
    weight = np.where(y > 0, prior / n_bad, (1 - prior) / n_good)
    x = x.astype(np.float64)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * x + b)
        g = np.array([(weight * (p - y) * x).sum() + 1e-3 * (a - 1), (weight * (p - y)).sum()])
        q = weight * p * (1 - p) + 1e-9
        hess = np.array([[(q * x * x).sum() + 1e-3, (q * x).sum()], [(q * x).sum(), q.sum() + 1e-6]])
        d = np.linalg.solve(hess, g)
        a, b = a - float(np.clip(d[0], -1, 1)), b - float(np.clip(d[1], -2, 2))
    return max(a, 0.0), b


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, folds: int = 5) -> tuple[list[bytes], list[int], float]:
    """At most `rows` labelled texts outside the held-out fold, chosen by hash, and the share of toxic labels.

    Texts above `SAMPLE_TEXT` bytes are not chosen, so that what the driver gets is at most `rows` times that.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1))
    known = known.where(F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), folds) != 0))
    # An id with both labels is toxic.
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).first()
    prior = (counts["bad"] or 0) / max(1, counts["n"])
    order = F.xxhash64("doc_id")
    # Top-k by hash of each class: the bound is exact, and so is that of the broadcast below.
    picked = known.where("toxic = 1").orderBy(order).limit(rows // 2).unionByName(
        known.where("toxic = 0").orderBy(order).limit(rows - rows // 2)
    )
    texts = docs.select("doc_id", "text").where(F.octet_length("text") <= SAMPLE_TEXT)
    # Rows may repeat an id; as many as the bound are taken.
    found = texts.join(F.broadcast(picked), "doc_id").orderBy(order, F.md5("text")).limit(rows).collect()
    return [r["text"].encode() for r in found], [r["toxic"] for r in found], prior


def scored(net: Network, text_at: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches with the score of each row's text."""
    lean_worker()
    table = WordTable(net.projected)
    for batch in batches:
        texts = text_bytes(batch.column(text_at))
        for part in chunks([len(t) for t in texts], CHUNK_BYTES):
            logits = net.window_logits([words_of(t) for t in texts[part]], table)
            yield batch[part], net.probability(np.array([v.max() for v in logits]))


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, folds: int = 5) -> DataFrame:
    """`doc_id, held_out, score, predicted` of every row.

    A null or empty text, or one of white space, has a single empty window and the score of that. Rows are scored
    one by one, so repeated rows get repeated results; an empty table gives no rows. Without labels of both kinds
    every score is the share of toxic labels (null labels are left out).
    """
    net = train(*sample(docs, labels, rows, folds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in scored(net, 1, batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows_in = id_and_text(docs).withColumn("held_out", fold_of(F.col("doc_id"), folds) == 0)
    return rows_in.mapInArrow(run, row_schema(docs, "held_out boolean, score double, predicted int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, folds: int = 5) -> DataFrame:
    """The rows of `docs`, with all their columns, that are not predicted toxic."""
    net = train(*sample(docs, labels, rows, folds))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in scored(net, at, batches):
            yield batch.filter(pa.array(scores < 0.5))

    return docs.mapInArrow(run, docs.schema)
