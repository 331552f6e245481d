"""Language identification: averaged embeddings of hashed subwords under a linear softmax.

A text is the average of the embeddings of its words and of their character n-grams, hashed to buckets; a linear
layer and a softmax give the languages. Training is stochastic gradient descent in numpy on a bounded sample of
labelled rows. On held-back rows of the sample the softmax is calibrated by a temperature, and the probability
below which a prediction is to be refused is set. Scoring is linear before the softmax, so each bucket is reduced
to one number per language, and each distinct word of a batch is looked up once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlayers.llm.common import (
    WordTable,
    chunks,
    fold_of,
    hash_words,
    id_and_text,
    row_schema,
    sum_by,
    text_bytes,
)

#: Rows of the training sample, the bound of what the driver gets.
SAMPLE_ROWS = 4_000
#: Bytes of the longest text of the sample.
SAMPLE_TEXT = 1 << 16
BUCKETS = 1 << 16
DIMENSIONS = 16
EPOCHS = 6
RATE = 0.5
GRAMS = (2, 3, 4)
#: The part of held-back predictions that rejection may refuse.
REFUSED = 0.01
UNKNOWN = "und"
CHUNK_BYTES = 4 << 20


def subwords(words: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of each word, one after the other, and how many each word has: the word itself and
    the n-grams of its bytes between marks of its start and end."""
    marked = [b"<" + w + b">" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    keys, owners = [hash_words(words)], [np.arange(len(words))]
    for n in GRAMS:
        if len(data) < n:
            continue
        code = np.zeros(len(data) - n + 1, np.uint64)
        for k in range(n):
            code = code * np.uint64(0x100000001B3) + data[k : len(data) - n + 1 + k] + np.uint64(1)
        inside = owner[: len(code)] == owner[n - 1 :]
        keys.append((code[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(n))
        owners.append(owner[: len(code)][inside])
    key, own = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    bucket = ((key >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)[order]
    return bucket, np.bincount(own, minlength=len(words))


def lettered(text: str) -> bool:
    return any(map(str.isalpha, text))


def text_words(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().split()


@dataclass
class Model:
    languages: list[str]
    #: Per bucket one score for each language, after the linear layer.
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    refuse_below: float

    def per_word(self, words: list[bytes]) -> np.ndarray:
        """The summed scores of each word's subwords, and in the last column how many there are."""
        bucket, many = subwords(words)
        of_bucket = self.scores[bucket]
        return np.column_stack([*(sum_by(of_bucket[:, k], many) for k in range(len(self.languages))), many])

    def logits(self, texts: list[list[bytes]], table: WordTable | None = None) -> np.ndarray:
        """One row per text; a text without words has the bias alone."""
        table = table or WordTable(self.per_word)
        ids = table.ids(texts)
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        out = np.tile(self.bias, (len(texts), 1))
        if len(ids):
            rows = table.rows[ids]
            sums = np.column_stack([sum_by(rows[:, k], counts) for k in range(rows.shape[1])])
            out += sums[:, :-1] / np.maximum(sums[:, -1:], 1)
        return out

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[bytes], labels: list[str], seed: int = 11) -> Model:
    """Fits the embeddings and the linear layer; every tenth text is held back for calibration."""
    languages = sorted(set(labels)) or [UNKNOWN]
    target = np.array([languages.index(x) for x in labels], np.int64)
    rng = np.random.default_rng(seed)
    words = [text_words(t) for t in texts]
    bags = []
    for w in words:
        bucket, _ = subwords(w) if w else (np.zeros(0, np.int64), None)
        ids, n = np.unique(bucket, return_counts=True)
        bags.append((ids, (n / max(1, n.sum())).astype(np.float32)))
    embed = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weight = rng.normal(0, 1 / DIMENSIONS, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    fit = [i for i in range(len(texts)) if i % 10] or list(range(len(texts)))
    held = [i for i in range(len(texts)) if not i % 10]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(fit):
            ids, share = bags[i]
            if not len(ids):
                continue
            x = share @ embed[ids]
            p = softmax((x @ weight + bias)[None])[0]
            p[target[i]] -= 1
            into = weight @ p
            weight -= rate * np.outer(x, p)
            bias -= rate * p
            # The average spreads a step over all subwords; as many steps as it has subwords' worth are taken back.
            embed[ids] -= (rate * 20) * share[:, None] * into
    model = Model(languages, (embed @ weight).astype(np.float64), bias.astype(np.float64), 1.0, 0.0)
    if held:
        logits = model.logits([words[i] for i in held])
        truth = target[held]
        grid = np.geomspace(1, 10, 40)
        loss = [-np.log(softmax(logits / t)[np.arange(len(held)), truth] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        best = np.sort(model.probabilities(logits).max(axis=1))
        model.refuse_below = float(best[int(REFUSED * len(best))])
    return model


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, folds: int = 5) -> tuple[list[bytes], list[str]]:
    """At most `rows` labelled rows outside the held-out fold, an even part of each language, chosen by hash.

    Texts above `SAMPLE_TEXT` bytes are not chosen, so that what the driver gets is at most `rows` times that.
    """
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & (F.octet_length("text") <= SAMPLE_TEXT))
    labelled = labelled.where(fold_of(F.col("doc_id"), folds) != 0)
    languages = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(rows).collect()
    each = max(1, rows // max(1, len(languages)))
    texts: list[bytes] = []
    labels: list[str] = []
    part = F.least(F.lit(1.0), F.lit(2.0 * each) / F.col("n"))
    sizes = docs.sparkSession.createDataFrame([(r["lang"], r["n"]) for r in languages], "lang string, n bigint")
    # A row is a candidate by its hash; ordering by the hash and cutting makes the bound exact.
    chance = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 20)) / float(1 << 20)
    chosen = labelled.join(F.broadcast(sizes), "lang").withColumn("chance", chance).where(F.col("chance") < part)
    first = Window.partitionBy("lang").orderBy("chance", "doc_id", F.md5("text"))
    best = chosen.withColumn("place", F.row_number().over(first)).where(F.col("place") <= each)
    for r in best.orderBy("chance", "doc_id", "lang", F.md5("text")).select("text", "lang").collect():
        texts.append(r["text"].encode())
        labels.append(r["lang"])
    return texts, labels


def identify(docs: DataFrame, model: Model, folds: int = 5) -> DataFrame:
    """`doc_id, held_out, lang_pred, score, rejected` of every row.

    A text that is null or has no letter is `und` with score zero and rejected. Rows are judged one by one, so
    repeated rows get repeated results; an empty table gives no rows. `rejected` marks predictions less likely
    than the calibrated bound; they still name the likeliest language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(model.per_word)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for part in chunks([len(t) for t in texts], CHUNK_BYTES):
                some = texts[part]
                p = model.probabilities(model.logits([text_words(t) for t in some], table))
                known = np.array([lettered(t.decode("utf-8", "replace")) for t in some], bool)
                best, top = p.argmax(axis=1), p.max(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part],
                        batch.column(2)[part],
                        pa.array([model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]),
                        pa.array(np.where(known, top, 0.0)),
                        pa.array(~known | (top < model.refuse_below)),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
                )

    rows = id_and_text(docs).withColumn("held_out", fold_of(F.col("doc_id"), folds) == 0)
    return rows.mapInArrow(
        run, row_schema(docs, "held_out boolean, lang_pred string, score double, rejected boolean")
    )


def language_id(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Trains on a bounded sample of the labelled rows and identifies all; without labels all is `und`."""
    return identify(docs, train(*sample(docs, rows)))
