"""Best-fit packing of documents into sequences, after dominance reduction.

Lengths are integers up to the capacity, so the whole instance is a histogram of at most `capacity` numbers,
whatever the size of the corpus. The plan is made on it, in bulk:

1. Reduction (Martello and Toth): a longest piece together with a partner is fixed for good where that set
   provably dominates every other way to fill its sequence: alone if nothing fits beside it, with a partner that
   fills the sequence to the last token, or with its best partner if every feasible set of other pieces has a
   smaller or equal total than that partner. What is fixed leaves the instance, which is then reduced again.
2. Best fit, decreasing: the remainder goes, longest first, into the fullest sequence that still takes it.

Pieces are ranked within their length by counts per task and prefix sums over those counts, and ranges of ranks
map to ranges of sequences; no task sees more than its own pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlayers.llm.bpe import CHUNK_BYTES, default_vocabulary, encoder
from eventlayers.llm.common import chunks, id_and_text, materialise, row_schema, text_bytes

CAPACITY = 1024
#: The id that ends each document.
END = 2


@dataclass
class Plan:
    """Slots: pieces of `length` with ranks from `rank` on, `many` of them, lie at `offset` of the sequences from
    `sequence` on. `fixed` is the number of sequences that the reduction settled."""

    capacity: int
    sequences: int = 0
    fixed: int = 0
    slots: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    used: dict[int, int] = field(default_factory=dict)

    def add(self, lengths: list[int], many: int) -> None:
        """`many` sequences, each holding pieces of these lengths."""
        offset = 0
        for length in lengths:
            rank = self.used.get(length, 0)
            self.slots.append((length, rank, many, self.sequences, offset))
            self.used[length] = rank + many
            offset += length
        self.sequences += many


def _beaten(counts: np.ndarray, room: int, best: int) -> bool:
    """Whether two or more pieces from `counts` can add up to more than `best` and at most `room`. The sums are bits
    of an integer; equal pieces are taken in blocks of one, two, four, ..."""
    mask = (1 << (room + 1)) - 1
    one = more = 0
    for s in np.flatnonzero(counts[: room + 1]).tolist():
        left, block = min(int(counts[s]), room // s), 1
        while left:
            k = min(block, left)
            shift = k * s
            more |= (more << shift) | (one << shift) | (1 << shift if k > 1 else 0)
            one |= 1 << s if k == 1 else 0
            left, block = left - k, 2 * block
        more &= mask
        if more >> (best + 1):
            return True
    return False


def reduce_instance(counts: np.ndarray, plan: Plan) -> np.ndarray:
    """Fixes dominating sets in `plan`; returns what is left."""
    counts = counts.copy()
    room_for = plan.capacity

    def fix(lengths: list[int], many: int) -> None:
        for length in lengths:
            counts[length] -= many
        plan.add(lengths, many)
        plan.fixed += many

    changed = True
    while changed:
        changed = False
        for w in range(room_for, 0, -1):
            if not counts[w]:
                continue
            rest = room_for - w
            others = counts.copy()
            others[w] -= 1
            fitting = np.flatnonzero(others[: rest + 1])
            if not len(fitting):
                fix([w], int(counts[w]))
                changed = True
                continue
            best = int(fitting[-1])
            # Taking pieces away leaves fewer alternatives, so what dominates once does so for every copy.
            if best == rest or not _beaten(others, rest, best):
                fix([w, best], int(counts[w] // 2 if best == w else min(counts[w], counts[best])))
                changed = True
    return counts


def best_fit(counts: np.ndarray, plan: Plan) -> None:
    """Packs the remainder in bulk: equal sequences are one group, held by the room they have left."""
    groups: dict[int, list[tuple[list[int], int]]] = {}
    for w in range(plan.capacity, 0, -1):
        left = int(counts[w])
        while left:
            room = min((r for r, g in groups.items() if r >= w and g), default=None)
            if room is None:
                room, (held, many) = plan.capacity, ([], -(-left // (plan.capacity // w)))
            else:
                held, many = groups[room].pop()
                if not groups[room]:
                    del groups[room]
            each = room // w
            full = min(many, left // each)
            rest = left - full * each
            if full:
                groups.setdefault(room - each * w, []).append((held + [w] * each, full))
                left -= full * each
            if many > full:
                if 0 < rest < each and left:
                    groups.setdefault(room - rest * w, []).append((held + [w] * rest, 1))
                    left -= rest
                    full += 1
                if many > full and held:
                    groups.setdefault(room, []).append((held, many - full))
    for room in sorted(groups):
        for held, many in groups[room]:
            plan.add(held, many)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Where the pieces go, from the number of pieces of each length."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan = Plan(capacity)
    best_fit(reduce_instance(counts, plan), plan)
    return plan


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document: whole capacities, a shorter piece first."""
    whole, short = divmod(total, capacity)
    return [short] * (short > 0) + [capacity] * whole


def pieces_of(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its length, checksum, and place among the pieces of that length in its task."""
    path = vocabulary or default_vocabulary()
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for part in chunks([len(t) for t in texts], 4 * CHUNK_BYTES):
                rows: list[tuple] = []
                owner: list[int] = []
                for k, ids in enumerate(codec.encode(texts[part])):
                    ids += end
                    start = 0
                    for n, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((n, start, length, crc, seen[length]))
                        owner.append(part.start + k)
                        seen[length] += 1
                        start += length
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner, pa.int64())),
                        pa.array(cols[0], pa.int32()),
                        *(pa.array(c, pa.int64()) for c in cols[1:]),
                        pa.array([task] * len(rows), pa.int32()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "place", "task"],
                )

    schema = row_schema(docs, "piece int, start bigint, length bigint, ids_crc32 bigint, place bigint, task int")
    return id_and_text(docs).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: `doc_id, piece, start, length, ids_crc32, sequence_id, offset`.

    A null or empty text is its end id alone. Rows are packed one by one, so repeated rows and ids are packed as
    often as they come; an empty table gives no rows. Ties between equal lengths are broken by place in the input.
    """
    pieces = materialise(pieces_of(docs, vocabulary, capacity), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing(histogram, capacity)
    slots = np.array(sorted(plan.slots), np.int64).reshape(-1, 5)
    wide = np.int64(1) << 48
    keys = slots[:, 0] * wide + slots[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            length = batch.column(at("length")).to_numpy()
            rank = batch.column(at("rank")).to_numpy()
            slot = slots[np.searchsorted(keys, length * wide + rank, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(at(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                    pa.array(slot[:, 3] + rank - slot[:, 1]),
                    pa.array(slot[:, 4]),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(bases, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("rank")
    )
    rest = "piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, row_schema(docs, rest))
