"""Language-model scoring by partial matching.

The model is the byte-context trie of orders 0 to `ORDER` over all training texts. A byte is predicted in its
longest context, where it has (2 n - 1) / (2 N) of n in N symbols; a context that has not seen it escapes to the
next shorter one with probability kinds / (2 N), and there the bytes that the longer context knows are excluded
from the counts. Below order 0 every symbol left is equally likely. Symbol 256 ends a text; contexts before the first byte are zeros.

The trie is fully counted, so what a longer context excludes is what it has seen, and the code length of a byte is
a function of the byte and its longest context alone. The work is therefore done per distinct gram (context and
byte) instead of per byte of text:

1. documents are dealt to groups of bounded bytes; each group lists its distinct grams and words with their
   training counts;
2. counts are summed over the groups, the grams are sharded by the end of their context (so that a shard holds all
   contexts between which its grams escape) and get their log probabilities;
3. each group receives the grams and words that it asked for, and sums them over its documents.

There are as many shards as the grams need, by the last two bytes of the context; a pair of bytes with more grams than a shard
should hold is dealt further by the byte before, with the counts of its order 2 passed along, as those of order 1 are
for all. A shard then has at most the 2^16 contexts that end in three given bytes besides what hashes to it. What is
broadcast or collected is bounded by the number of byte pairs (65,536) times symbols (257), whatever the corpus.

The score sees bytes as they are; only the base lower-cases A-Z.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from eventlayers.llm.common import chunks, fold_of, id_and_text, lean_worker, materialise, row_schema, sum_by, text_bytes

ORDER = 5
END = 256
SYMBOLS = 257
#: Most bytes of text in a group of documents, groups that even a small corpus is dealt to (of `LEAST_BYTES` at least),
#: and bytes of the parts in which a group is read.
GROUP_BYTES, GROUPS, LEAST_BYTES = 16 << 20, 12, 4 << 20
CHUNK_BYTES, CHUNK_DOCS = 1 << 20, 1 << 14
PACK_BYTES = 8 << 20
#: Grams that a shard should hold.
SHARD_GRAMS = 1_000_000
WORD = -1
_PAIR = 0xFFFF


def gram_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The code of each symbol with its context, text after text, and the number of symbols of each text.

    A code is the context's bytes, oldest first, then the symbol in nine bits.
    """
    pad = bytes(ORDER)
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t, b"\0")), np.uint8).astype(np.int64)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    ends = np.cumsum(lengths + ORDER) - 1
    context = np.zeros(len(data) - ORDER, np.int64)
    for k in range(ORDER):
        context = (context << 8) | data[k : len(data) - ORDER + k]
    symbol = data[ORDER:].copy()
    symbol[ends - ORDER] = END
    codes = (context << 9) | symbol
    real = np.ones(len(codes), bool)
    for k in range(ORDER):
        real[ends[:-1] - ORDER + 1 + k] = False
    return codes[real], lengths


def dealt(docs: DataFrame, group_bytes: int, folds: int, held: int) -> DataFrame:
    """`part, docs`: the documents with their fold, dealt to groups; each row holds what a batch has of one group, as a
    compressed Arrow stream, since texts cross shuffles twice."""
    rows = id_and_text(docs).withColumn("held_out", fold_of(F.col("doc_id"), folds) == held)
    total = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    groups = max(1, -(-total // group_bytes), min(GROUPS, -(-total // min(LEAST_BYTES, group_bytes))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        for batch in batches:
            part = batch.column(3).to_numpy()
            for some in chunks([len(t) for t in text_bytes(batch.column(1))], PACK_BYTES):
                for p in np.unique(part[some]):
                    own = batch.take(pa.array(some.start + np.flatnonzero(part[some] == p)))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, own.schema, options=options) as writer:
                        writer.write_batch(own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p], pa.int32()), pa.array([sink.getvalue().to_pybytes()])], names=["part", "docs"]
                    )

    # A text longer than a group is one row and cannot be dealt further.
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int"))
    return rows.mapInArrow(pack, "part int, docs binary")


def unpacked(table: pa.Table) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """The documents of a group in parts of about `CHUNK_BYTES`, with their texts."""
    for packed in table.column("docs"):
        docs = pa.ipc.open_stream(packed.as_buffer()).read_all()
        texts = text_bytes(docs.column(1).combine_chunks())
        for some in chunks([len(t) + CHUNK_BYTES // CHUNK_DOCS for t in texts], CHUNK_BYTES):
            yield docs.slice(some.start, some.stop - some.start), texts[some]


def symbols_of(table: pa.Table) -> int:
    """Number of symbols of a group."""
    n = 0
    for packed in table.column("docs"):
        texts = pa.ipc.open_stream(packed.as_buffer()).read_all().column(1).combine_chunks()
        n += len(texts) + int(pc.sum(pc.binary_length(texts)).as_py() or 0)
    return n


def distinct_codes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes in `keys` (a code, then one bit that is set outside training), and how often each is in training.

    Sorts `keys` in place.
    """
    keys.sort()
    at = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    kinds = keys[at]
    counts = np.where(kinds & 1, 0, np.diff(at, append=len(keys)))
    codes = kinds >> 1
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(codes)), bool), codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def group_statistics(rows: DataFrame) -> DataFrame:
    """`part, code, word, n`: what each group asks for, with its training counts; the empty word is the end."""

    def count(table: pa.Table) -> pa.Table:
        lean_worker()
        words, unseen = Counter({b"": 0}), set()
        keys, at = np.empty(symbols_of(table), np.int64), 0
        for docs, texts in unpacked(table):
            held = docs.column("held_out").to_numpy()
            codes, lengths = gram_codes(texts)
            keys[at : at + len(codes)] = (codes << 1) | np.repeat(held, lengths)
            at += len(codes)
            for t, out in zip(texts, held.tolist()):
                if out:
                    unseen.update(t.lower().split())
                else:
                    words.update(t.lower().split())
            words[b""] += len(texts) - int(held.sum())
        words.update(dict.fromkeys(unseen, 0))
        codes, counts = distinct_codes(keys)
        del keys
        part = table.column("part")[0].as_py()
        return pa.table({
            "part": pa.array(np.full(len(codes) + len(words), part, np.int32)),
            "code": np.concatenate([codes, np.full(len(words), WORD)]),
            "word": pa.concat_arrays([pa.nulls(len(codes), pa.binary()), pa.array(words.keys(), pa.binary())]),
            "n": np.concatenate([counts, np.fromiter(words.values(), np.int64, len(words))]),
        })

    schema = "part int, code bigint, word binary, n bigint"
    return rows.groupBy("part").applyInArrow(count, schema)


def log_probabilities(
    codes: np.ndarray, counts: np.ndarray, low: np.ndarray, hot: np.ndarray, hot_counts: np.ndarray
) -> np.ndarray:
    """log10 of the probability of each gram, given all grams of its shard and `low[context byte, symbol]`, the counts
    of order 1.

    All contexts that end in the same two bytes must be in the shard; for pairs in `hot`, which is sorted, only those
    that end in the same three, as `hot_counts[pair's place, symbol]` has the counts of order 2.
    """
    symbol = codes & 511
    # Counts of each order, at each gram: of the symbol, of the context, and the kinds it has seen.
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    for order in range(ORDER, 1, -1):
        suffix = codes & ((1 << (8 * order + 9)) - 1)
        keys, at = np.unique(suffix, return_inverse=True)
        n = np.bincount(at, counts, len(keys))
        if order == 2:
            place = np.searchsorted(hot, keys >> 9)
            is_hot = place < len(hot)
            is_hot[is_hot] = hot[place[is_hot]] == keys[is_hot] >> 9
            place = place[is_hot]
            n[is_hot] = hot_counts[place, keys[is_hot] & 511]
        levels.append((keys >> 9, keys & 511, n, at))
    first = (codes >> 9) & 255
    zero = low.sum(axis=0)
    log_p = np.zeros(len(codes))
    done = np.zeros(len(codes), bool)
    # Excluded: what the next longer context has seen, as counts and kinds in the present one.
    out_count = np.zeros(len(codes))
    out_kinds = np.zeros(len(codes))
    for k, order in enumerate(range(ORDER, -1, -1)):
        if order > 1:
            context, _, n, at = levels[k]
            c = n[at]
            _, ctx = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(ctx, n)[ctx], np.bincount(ctx, n > 0)[ctx]
            if order == 2:
                total[is_hot] = hot_counts.sum(axis=1)[place]
                kinds[is_hot] = (hot_counts > 0).sum(axis=1)[place]
            total, kinds = total[at], kinds[at]
        elif order == 1:
            c = low[first, symbol]
            total, kinds = low.sum(axis=1)[first], (low > 0).sum(axis=1)[first]
        else:
            c, total, kinds = zero[symbol], np.full(len(codes), zero.sum()), np.full(len(codes), (zero > 0).sum())
        free, types = total - out_count, kinds - out_kinds
        here = ~done & (types > 0)
        hit = here & (c > 0)
        log_p[hit] += np.log10((2 * c[hit] - 1) / (2 * free[hit]))
        done |= hit
        miss = here & ~hit
        log_p[miss] += np.log10(types[miss] / (2 * free[miss]))
        if order > 2:
            # What this context has seen, counted in the next shorter one.
            n_short, at_short = levels[k + 1][2], levels[k + 1][3]
            one = np.zeros(len(context), np.int64)
            one[at] = np.arange(len(codes))
            in_short = n_short[at_short[one]]
            out_count = np.bincount(ctx, np.where(n > 0, in_short, 0))[ctx][at]
        elif order == 2:
            in_short = low[context & 255, levels[k][1]]
            out_count = np.bincount(ctx, np.where(n > 0, in_short, 0))[ctx]
            out_count[is_hot] = np.where(hot_counts > 0, low[hot & 255], 0).sum(axis=1)[place]
            out_count = out_count[at]
        elif order == 1:
            out_count = np.where(low > 0, zero[None, :], 0).sum(axis=1)[first]
        out_kinds = kinds
    rest = ~done
    log_p[rest] -= np.log10(SYMBOLS - (zero > 0).sum())
    return log_p


def score_texts(
    docs: DataFrame, folds: int = 7, held: int = 2, group_bytes: int = GROUP_BYTES, shard_grams: int = SHARD_GRAMS
) -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score` of every row.

    The model and the base's word counts come from all rows outside the held-out fold. A null or empty text is its
    end alone. Rows are scored one by one, so repeated rows get repeated results and count as often in training; an
    empty table gives no rows; without training rows every byte has the same probability.
    """
    rows = dealt(docs, group_bytes, folds, held)
    asked = materialise(group_statistics(rows), "gram-counts")
    grams = materialise(asked.where(F.col("code") != WORD).groupBy("code").agg(F.sum("n").alias("n")), "grams")
    # One shuffle gives each group's words their counts in all groups. A word has one row for each group at most (16 MB of
    # text each), so a frequent word is millions of narrow rows at 100 TB, which the window spills.
    word = Window.partitionBy("word")
    words = asked.where(F.col("code") == WORD).select(
        "part", "word", F.sum("n").over(word).cast("double").alias("value"), (F.min("part").over(word) == F.col("part")).alias("first")
    )
    words = materialise(words, "words")
    known = words.where("first").agg(F.sum("value").alias("tokens"), F.count_if(F.col("value") > 0).alias("kinds")).first()
    tokens, kinds = int(known["tokens"] or 0), known["kinds"] or 0
    # At most 256 contexts of one byte times 257 symbols: bounded whatever the corpus.
    low = np.zeros((256, SYMBOLS))
    pair = F.shiftright("code", 9).bitwiseAND(255)
    of_order_1 = grams.groupBy(pair.alias("byte"), F.col("code").bitwiseAND(511).alias("symbol")).agg(F.sum("n").alias("n"))
    for r in of_order_1.collect():
        low[r["byte"], r["symbol"]] = r["n"]

    last_two = F.shiftright("code", 9).bitwiseAND(_PAIR)
    sizes = dict(grams.groupBy(last_two.alias("pair")).count().collect())
    shards = max(1, -(-sum(sizes.values()) // shard_grams))
    hot = np.array(sorted(p for p, n in sizes.items() if n > shard_grams), np.int64)
    hot_counts = np.zeros((len(hot), SYMBOLS))
    is_hot = last_two.isin(hot.tolist())
    if len(hot):
        of_order_2 = grams.where(is_hot).groupBy(last_two.alias("pair"), F.col("code").bitwiseAND(511).alias("symbol"))
        for r in of_order_2.agg(F.sum("n").alias("n")).collect():
            hot_counts[np.searchsorted(hot, r["pair"]), r["symbol"]] = r["n"]
    few = docs.sparkSession.sparkContext.broadcast((low, hot, hot_counts))

    def shard_probabilities(table: pa.Table) -> pa.Table:
        lean_worker()
        codes, counts = table.column("code").to_numpy(), table.column("n").to_numpy().astype(np.float64)
        return pa.table({"code": codes, "value": log_probabilities(codes, counts, *few.value)})

    third = F.when(is_hot, F.shiftright("code", 25).bitwiseAND(255)).otherwise(-1)
    shard = F.pmod(F.xxhash64(last_two, third), F.lit(shards))
    priced = grams.groupBy(shard.alias("shard")).applyInArrow(shard_probabilities, "code bigint, value double")
    answers = (
        asked.where(F.col("code") != WORD).select("part", "code").join(priced, "code")
        .select("part", "code", F.lit(None).cast("binary").alias("word"), "value")
        .unionByName(words.select("part", F.lit(WORD).cast("long").alias("code"), "word", "value"))
    )

    rest = "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    schema = row_schema(docs, rest)

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        lean_worker()
        code, value = answers.column("code").to_numpy(), answers.column("value").to_numpy()
        is_word = code == WORD
        # Zero for words that training has not seen, and above zero for the others.
        gain = dict(zip(answers.column("word").filter(pa.array(is_word)).to_pylist(), np.log10(value[is_word] + 1).tolist()))
        order = np.argsort(code[~is_word])
        codes, log_p = code[~is_word][order], value[~is_word][order]
        floor = np.log10(tokens + kinds + 1)
        out = [pa.table([[], [], [], [], [], [], []], schema=to_arrow_schema(schema))]
        for docs, texts in unpacked(table):
            got, lengths = gram_codes(texts)
            # Equal codes come together and are looked up once; the document goes along.
            got = (got << 14) | np.repeat(np.arange(len(texts)), lengths)
            got.sort()
            keys = got >> 14
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            found = np.repeat(log_p[np.searchsorted(codes, keys[at])], np.diff(at, append=len(keys)))
            split = [t.lower().split() for t in texts]
            many = np.fromiter(map(len, split), np.int64, len(split))
            gains = np.fromiter((gain[w] for t in split for w in t), np.float64, int(many.sum()))
            end, many_and_end = gain[b""], many + 1
            out.append(pa.table({
                "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": many_and_end,
                "n_known": sum_by(gains > 0, many).astype(np.int64) + int(end > 0), "train_tokens": np.full(len(texts), tokens),
                "base_score": sum_by(gains, many) + end - floor * many_and_end,
                "score": np.bincount(got & (CHUNK_DOCS - 1), found, len(texts)),
            }, schema=out[0].schema))
        return pa.concat_tables(out)

    return rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(score, schema)
