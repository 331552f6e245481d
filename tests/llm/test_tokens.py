"""Encoding, token counts and packing against the tokenizers library."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventlayers.llm import bpe, packing, token_counts
from eventlayers.session import scratch_dir


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def codec():
    return bpe.Encoder(bpe.default_vocabulary())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


MARKS = ["'", "'s", "'ll", "<|endoftext|>", "<|", "\n", " ", "  ", "\t", " ", "　", "é", "東", "🙂", "1", "!?", "ing", "Q", "\x85"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(MARKS), st.text(max_size=4)), max_size=12).map("".join))
def test_any_text_is_encoded_as_the_library_does(text):
    codec = bpe.encoder(bpe.default_vocabulary())
    text = text.encode("utf-8", "ignore").decode()
    ids = np.frombuffer(codec.encode([text.encode()])[0], "<u4").tolist()
    assert ids == ids_of(codec.library, text)
    assert codec.decode(np.array(ids, "<u4").tobytes()).decode() == codec.library.decode(ids, skip_special_tokens=False)


def test_broken_ids_decode_as_the_library_does(codec, library):
    rng = random.Random(5)
    for _ in range(200):
        ids = [rng.randrange(library.get_vocab_size()) for _ in range(rng.randrange(1, 9))]
        assert codec.decode(np.array(ids, "<u4").tobytes()).decode() == library.decode(ids, skip_special_tokens=False)


def test_cuts_never_fall_inside_a_token(codec):
    for token in codec.tokens:
        if token not in codec.special:
            assert len(codec.fragments(token)) <= 1


def test_a_small_cache_gives_the_same_ids(codec, texts, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 10)
    small = bpe.Encoder(bpe.default_vocabulary())
    data = [(t or "").encode() for _, t in texts]
    assert [x for t in data for x in small.encode([t])] == codec.encode(data)


def test_digests(frame, texts, library):
    want = []
    for i, text in texts:
        ids = ids_of(library, text)
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((
            i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        ))
    assert table(bpe.encode_digests(frame)) == sorted(want, key=repr)


def test_ids_round_trip(frame, texts):
    got = bpe.encode_documents(frame).collect()
    assert Counter((r.doc_id, r.decoded) for r in got) == Counter((i, t or "") for i, t in texts)
    assert all(len(r.ids) > 0 for r in got if r.decoded)


def test_empty_tables(empty):
    assert bpe.encode_digests(empty).count() == 0
    assert token_counts.count_tokens(empty).count() == 0
    assert packing.pack_documents(empty).count() == 0


def test_counts_and_cache(spark, frame, texts, library):
    cache = scratch_dir(spark, "cache")
    want = sorted(((i, len((t or "").encode()), n := len(ids_of(library, t)), n > 512) for i, t in texts), key=repr)
    half = frame.where("doc_id % 2 = 0")
    assert token_counts.count_tokens(half, cache).count() == half.count()
    stored = spark.read.parquet(cache).count()
    assert stored == half.select("text").na.fill("").distinct().count()
    assert table(token_counts.count_tokens(frame, cache)) == want
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in texts})
    assert table(token_counts.count_tokens(frame, cache)) == want
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in texts})


def test_stored_counts_are_taken_for_their_version_only(spark):
    cache = scratch_dir(spark, "cache")
    text = "stored"
    digest = hashlib.sha256(text.encode()).hexdigest()
    version = token_counts.tokenizer_version(bpe.default_vocabulary())
    rows = [(version, digest, 77), ("another", hashlib.sha256(b"new").hexdigest(), 88)]
    spark.createDataFrame(rows, token_counts.CACHE).write.parquet(cache)
    docs = spark.createDataFrame([(1, text), (2, "new")], "doc_id bigint, text string")
    assert [r[2] for r in table(token_counts.count_tokens(docs, cache))] == [77, 1]


def test_packing(frame, texts, library):
    got = packing.pack_documents(frame).collect()
    by_doc = defaultdict(list)
    for i, t in texts:
        by_doc[i].append([*ids_of(library, t), 2])
    found = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    want = Counter()
    for i, docs in by_doc.items():
        for ids in docs:
            start = 0
            for k, n in enumerate(packing.cut_lengths(len(ids), 1024)):
                want[i, k, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
                start += n
    assert found == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) <= sum(r.length for r in got) / 1024 * 1.02 + 1


def fewest(sizes, capacity):
    """The least number of sequences, by trying all."""
    best = len(sizes)

    def put(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for r in {*rooms}:
            if r >= sizes[k]:
                put(k + 1, [*[x for j, x in enumerate(rooms) if j != rooms.index(r)], r - sizes[k]])
        put(k + 1, [*rooms, capacity - sizes[k]])

    put(0, [])
    return best


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 13, 20])
    sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
    counts = np.bincount(sizes, minlength=capacity + 1)
    plan = packing.Plan(capacity)
    rest = packing.reduce_instance(counts, plan)
    left = [s for s in range(capacity, 0, -1) for _ in range(rest[s])]
    assert plan.fixed + (fewest(left, capacity) if left else 0) == fewest(sizes, capacity)


@pytest.mark.parametrize("seed", range(20))
def test_plans_hold_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 64, 1024])
    histogram = {rng.randint(1, capacity): rng.randint(1, 5000) for _ in range(rng.randint(0, 60))}
    plan = packing.plan_packing(histogram, capacity)
    used = defaultdict(int)
    held = Counter()
    for length, rank, many, first, offset in sorted(plan.slots):
        assert used[length] == rank
        used[length] += many
        if plan.sequences < 20000:
            for s in range(first, first + many):
                held[s] += length
    assert used == histogram and all(v <= capacity for v in held.values())
    assert plan.sequences >= -(-sum(a * b for a, b in histogram.items()) // capacity)


def test_best_fit_fills_the_fullest_sequence():
    plan = packing.plan_packing({6: 1, 5: 1, 4: 2, 3: 1}, 10)
    assert plan.sequences == 3 and list(itertools.islice(sorted(plan.used), 3)) == [3, 4, 5]


def test_a_second_run_encodes_nothing(spark, frame, tmp_path, monkeypatch):
    """Without a path the cache is one place in the shared folder, named by the tokenizer's version."""
    monkeypatch.setattr(token_counts, "shared_dir", lambda _: str(tmp_path))
    first = table(token_counts.count_tokens(frame))
    runs = list(tmp_path.glob("eventlayers/token-counts/*/run=*"))
    assert len(runs) == 1 and runs[0].parent.name == token_counts.tokenizer_version(token_counts.default_vocabulary())
    again = token_counts.count_tokens(frame.unionByName(frame.selectExpr("doc_id", "text || ' more' text", "length")))
    assert set(first) <= set(table(again))
    stored = [spark.read.parquet(str(r)).count() for r in sorted(tmp_path.glob("eventlayers/token-counts/*/run=*"), key=lambda p: p.stat().st_mtime)]
    assert table(token_counts.count_tokens(frame)) == first
    new = [r for r in tmp_path.glob("eventlayers/token-counts/*/run=*") if spark.read.parquet(str(r)).count() == 0]
    assert len(stored) == 2 and 0 < stored[1] <= stored[0] and len(new) == 1
