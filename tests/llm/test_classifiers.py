"""Toxicity and language identification: gradients, held-out quality, and awkward rows."""

import zlib

import numpy as np
import pytest

from eventlayers.llm import langid, toxicity
from eventlayers.llm.common import WordTable

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


# --- toxicity -------------------------------------------------------------------------------


def test_gradients():
    net = toxicity.Network.new(np.random.default_rng(1))
    for k, w in net.weights.items():
        w[...] = np.random.default_rng(2).normal(0, 0.5, w.shape)
    words = [b" ", b"ab", b"abc", b"xyz"]
    chars, many = toxicity.char_buckets(words)
    buckets = (toxicity.word_buckets(words), np.ones(4, np.float32), chars, many)
    ids, y = np.array([[1, 2], [3, 0], [2, 0]]), np.array([1, 0], np.float32)
    mask = np.array([[1, 1], [1, 0], [1, 0]], bool)

    def loss():
        p = toxicity.sigmoid(net.logits(net.projected(words), ids, mask).astype(float))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for k, g in net.gradients(ids, mask, y, words, buckets).items():
        w = net.weights[k]
        at = np.unravel_index(np.abs(g).argmax(), w.shape)
        old = w[at]
        w[at] = old + 3e-3
        up = loss()
        w[at] = old - 3e-3
        down = loss()
        w[at] = old
        assert g[at] == pytest.approx((up - down) / 6e-3, rel=0.02, abs=1e-4)


@pytest.mark.parametrize("n", [0, 1, 23, 24, 25, 36, 37, 100])
def test_windows_cover_the_text_and_overlap(n):
    starts = toxicity.window_starts(n)
    assert starts[0] == 0 and starts[-1] + toxicity.WINDOW >= n
    assert all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:]))


def test_windows_score_as_one_by_one():
    net = toxicity.Network.new(np.random.default_rng(3))
    for w in net.weights.values():
        w[...] = np.random.default_rng(4).normal(0, 0.5, w.shape)
    texts = [[b"w%d" % (i * j % 17) for i in range(n)] for j, n in enumerate([0, 3, 24, 30, 100, 1])]
    got = net.window_logits(texts, WordTable(net.projected))
    for t, logits in zip(texts, got):
        for start, v in zip(toxicity.window_starts(len(t)), logits, strict=True):
            own = t[start : start + toxicity.WINDOW]
            pad = [*own, *[b"other"] * (toxicity.WINDOW - len(own))]
            mask = (np.arange(toxicity.WINDOW) < len(own))[:, None]
            alone = net.logits(net.projected(pad), np.arange(len(pad))[:, None], mask)
            assert v == pytest.approx(float(alone[0]), abs=1e-4)


def test_held_out_toxicity(docs, labels):
    # Some labels are noise; documents with one of the generator's slurs are the certain ones.
    slurs = r"\b(?:trash|pathetic|idiot|disgusting|worthless|stupid|clown|loser|scum|moron)\b"
    big = docs.sparkSession.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8)
    known = docs.sparkSession.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.score_toxicity(big, known).join(big.select("doc_id", "text"), "doc_id").join(known, "doc_id").toPandas()
    held = rows[rows.held_out]
    certain = held.text.str.lower().str.contains(slurs)
    assert held.predicted[certain].mean() > 0.95
    assert held.predicted[held.toxic == 0].mean() < 0.02
    assert held.score.between(0, 1).all() and ((held.score >= 0.5) == (held.predicted == 1)).all()


def test_awkward_rows_have_scores(frame, labels, texts):
    rows = toxicity.score_toxicity(frame, labels, rows=60).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.drop_toxic(frame, labels, rows=60)
    assert kept.columns == frame.columns and kept.count() == sum(r.score < 0.5 for r in rows)


def test_without_labels(frame, labels, texts, empty):
    none = labels.where("false")
    assert all(r.score == pytest.approx(1e-6) for r in toxicity.score_toxicity(frame, none).collect())
    assert toxicity.score_toxicity(empty, labels).count() == 0
    assert toxicity.drop_toxic(empty, labels).count() == 0
    odd = labels.selectExpr("doc_id", "cast(null as int) toxic").union(labels.selectExpr("cast(null as bigint)", "1"))
    assert toxicity.score_toxicity(frame, odd).count() == len(texts)


# --- language -------------------------------------------------------------------------------


def test_held_out_languages(docs):
    rows = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.97
    assert rows.rejected.mean() < 0.1 and not (rows.score[rows.rejected] > rows.score[~rows.rejected].min()).any()


def test_texts_without_letters(spark, docs):
    model = langid.train(*langid.sample(docs, 200))
    rows = [(1, None), (2, ""), (3, "12 !? 🙂"), (None, "the of and"), (4, "東京"), (5, " \n"), (6, "x" * 50000)]
    frame = spark.createDataFrame([(i, t, "a") for i, t in rows], "doc_id bigint, text string, lang_pred string")
    found = {r.doc_id: r for r in langid.identify(frame, model).collect()}
    assert {i for i, r in found.items() if r.lang_pred == "und"} == {1, 2, 3, 5}
    assert all(found[i].score == 0 and found[i].rejected for i in (1, 2, 3, 5))
    assert all(0 < found[i].score <= 1 for i in (None, 4, 6))


HELD = "crc32(cast(doc_id as string)) % 5 = 0"


def test_sample_is_bounded_and_leaves_the_fold_out(docs):
    """Held-out rows have a language and a text of their own: neither is in the sample, and no answer depends on them."""
    marked = docs.selectExpr("doc_id", f"if({HELD}, 'xx', lang) lang", f"if({HELD}, concat('held ', text), text) text")
    texts, labels = langid.sample(marked, 100)
    assert len(texts) == len(labels) <= 100 and set(labels) == {"en", "de", "fr", "es"}
    assert not any(t.startswith(b"held ") for t in texts) and texts == langid.sample(docs, 100)[0]
    pairs = {(r.text.encode(), r.lang) for r in docs.select("text", "lang").collect()}
    assert set(zip(texts, labels)) <= pairs
    score = lambda some: {(r.doc_id, r.lang_pred, r.score) for r in langid.language_id(some, 200).collect()}
    changed = docs.selectExpr("doc_id", "text", f"if({HELD}, 'xx', lang) lang")
    assert score(changed) == score(docs)


def test_long_texts_are_not_in_the_sample(spark):
    rows = [(k, "ab cd " * (20_000 if k % 2 else 3), "en") for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {len(t) for t in langid.sample(frame)[0]} == {18}
    labels = spark.createDataFrame([(k, k % 4 == 0) for k in range(40)], "doc_id bigint, toxic boolean")
    assert {len(t) for t in toxicity.sample(frame, labels)[0]} == {18}


def test_language_scores_as_one_by_one(docs):
    """Every answer against the embeddings of its subwords, averaged and scored in plain numbers."""
    model = langid.train(*langid.sample(docs, 200))
    rows = docs.limit(40).select("doc_id", "text").collect()
    got = {r.doc_id: r for r in langid.identify(docs.limit(40), model).collect()}
    for doc_id, text in rows:
        total, n = np.zeros(len(model.languages)), 0
        for word in text.lower().split():
            for bucket in langid.subwords([word.encode()])[0]:
                total, n = total + model.scores[bucket], n + 1
        z = (model.bias + total / max(1, n)) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert got[doc_id].lang_pred == model.languages[int(p.argmax())] and got[doc_id].score == pytest.approx(p.max(), rel=1e-6)


def test_an_id_with_both_labels_is_toxic_and_the_fold_is_left_out(spark, labels, docs):
    rows = [(1, 0), (1, 1), (2, 0), (2, 0), (3, None), (3, 1), (4, 0), (None, 1)]
    texts = spark.createDataFrame([(k, f"text {k}") for k in (1, 2, 3, 4)], "doc_id bigint, text string")
    known = spark.createDataFrame(rows, "doc_id bigint, toxic int")
    want = {f"text {k}".encode(): y for k, y in ((1, 1), (2, 0), (3, 1), (4, 0)) if zlib.crc32(str(k).encode()) % 5}
    for _ in range(3):
        found, y, _ = toxicity.sample(texts, known.repartition(3))
        assert dict(zip(found, y)) == want and len(found) == len(want)
    flipped = labels.selectExpr("doc_id", f"if({HELD}, 1 - toxic, toxic) toxic")
    assert toxicity.sample(docs, flipped, 60) == toxicity.sample(docs, labels, 60)


def test_no_labelled_rows(spark, empty):
    assert langid.language_id(empty).count() == 0
    frame = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert [r.lang_pred for r in langid.language_id(frame).collect()] == ["und"]
