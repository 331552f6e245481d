"""Spelling variants against plain counts and every pair of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from helpers import table

from eventlayers.llm import variants

PLAIN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(PLAIN)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [] for w in words}
    some = sorted(words, key=len)
    for i, a in enumerate(some):
        for b in some[:i]:
            if len(a) - len(b) < 2 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def planted():
    """Chains of forms, ties, accents, equal neighbours, mutated runs and words at the bounds."""
    rng = random.Random(2)
    text = ["beginning"] * 700 + ["beginnin"] * 125 + ["beginnim"] * 25 + ["beginim"] * 5
    text += ["Übergang"] * 40 + ["übergang"] * 7 + ["ubergang"] * 200 + ["façades"] * 30 + ["facades"] * 6
    text += ["lettter"] * 5 + ["letter"] * 30 + ["lettfer"] * 30 + ["abcdef"] * 4 + ["abcde"] * 90 + ["a×b÷cd"] * 5
    text += ["bookkeeper"] * 50 + ["bokkeeper"] * 9 + ["bookeeper"] * 10 + ["bookkeepers"] * 8
    rng.shuffle(text)
    return [(k, " ".join(text[k::40]) + ("." if k % 2 else "\n7x")) for k in range(40)]


def test_whole_table_and_awkward_rows(frame, texts):
    assert table(variants.spelling_variants(frame)) == expected(texts)


def test_chains_ties_and_any_filter(spark):
    rows = planted() + [(None, "beginning " * 300), (None, None), (7, ""), (8, "Q" * 3000 + " " + "Q" * 3001)]
    frame = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, word int").repartition(4)
    want = expected(rows)
    chain = {r[0]: r for r in want}
    assert chain["beginim"][1:3] == ("beginnim", "beginning") and chain["beginnin"][2] == "beginning"
    assert len(chain) > 12
    for filter_bytes in (variants.FILTER_BYTES, 8):
        assert table(variants.spelling_variants(frame, filter_bytes)) == want


def test_mutated_runs_lose_the_letter_that_the_hash_names():
    seen = 0
    for doc_id in range(3000):
        h = zlib.crc32(f"{doc_id}:alphabet".encode())
        got = dict(variants.words_of(doc_id, "alphabet alphabet"))
        at = h % 8
        assert got == {("alphabet" if h % 199 else "alphabet"[:at] + "alphabet"[at + 1 :]): 2}
        seen += h % 199 == 0
    assert seen > 5


def test_edits_reach_every_near_pair_once():
    """With filters that let everything through, the edits are all deletions and all larger letters, each once."""
    alphabet = np.frombuffer("abcé".encode("latin-1"), np.uint8)
    full = {n: np.full(1, ~np.uint64(0)) for n in range(1, 9)}
    for word in ("aab", "abcabc", "ééé", "cba"):
        _, edits = variants.edited([word], full, alphabet)
        want = {word[:i] + word[i + 1 :] for i in range(len(word))}
        want |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in "abcé" if c > word[i]}
        assert sorted(edits) == sorted(want)


def test_filters_hold_every_word_and_stay_within_their_bytes(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abcdefghij", k=rng.randrange(6, 12))) for _ in range(4000)})
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint").repartition(3)
    for most in (1 << 20, 512):
        filters, alphabet = variants.bloom_filters(frame, most)
        assert bytes(alphabet).decode("latin-1") == "abcdefghij"
        assert sum(8 * len(f) for f in filters.values()) <= most
        for length, blocks in filters.items():
            own = [w for w in words if len(w) == length]
            assert variants.probe(variants.word_sums(variants.letters_matrix(own)), blocks).all()
    other = ["".join(rng.choices("klmnop", k=8)) for _ in range(4000)]
    filters, _ = variants.bloom_filters(frame)
    assert variants.probe(variants.word_sums(variants.letters_matrix(other)), filters[8]).mean() < 0.03


def test_empty_table(empty):
    assert variants.spelling_variants(empty).collect() == []
