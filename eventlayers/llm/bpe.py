"""Byte-pair encoding and decoding with forced boundaries.

A byte pair that occurs inside no token of the vocabulary can never be joined by a merge, so a text may be cut
between its two bytes and the parts encoded on their own. The cuts come from one lookup in a 256 x 256 table, the
parts are mostly words, and each distinct part is encoded by the tokenizers library once per worker and then
found in a cache of bounded size. Ids and decoded texts equal the library's.

The library first splits a text by a pattern of letters, digits, other marks and white space, so a cut is only
taken where it cannot change that split: the byte before must be visible ASCII (what follows white space decides
how white space is split), the byte after must start a character, and no cut touches an apostrophe (contractions).
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from eventlayers.llm.common import KEPT, chunks, id_and_text, row_schema, text_bytes

VOCABULARY = "byte_bpe_50k.json"
#: Entries of each of the two generations of a worker's cache, and the longest part that is kept there.
CACHE_ENTRIES = 200_000
CACHED_BYTES = 48
#: The first bytes of characters from U+0280 on are this or more.
LATIN_BELOW = 0xCA
#: Texts are encoded in chunks of about so many bytes.
CHUNK_BYTES = 1 << 20


def default_vocabulary() -> str:
    return str(public_tokenizers.path(VOCABULARY))


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for the 256 bytes in byte-level vocabularies: visible Latin-1 characters
    stand for themselves, the other bytes get the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Encodes and decodes with one vocabulary file; ids are little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        alphabet = byte_alphabet()
        self.special = {t.content.encode(): i for i, t in self.library.get_added_tokens_decoder().items()}
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        inside = np.zeros((256, 256), bool)
        for token, i in vocabulary.items():
            data = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
            self.tokens[i] = data
            for a, b in zip(data, data[1:]):
                inside[a, b] = True
        for data, i in self.special.items():
            self.tokens[i] = data
        cut = ~inside
        cut[:0x21] = cut[0x7F:] = False
        cut[:, 0x80:0xC0] = False
        cut[:, 0x27] = cut[0x27] = False
        for a, b in (b"re", b"ve", b"ll"):
            cut[a, b] = False
        self.cut = cut.reshape(-1)
        self.fast = self._by_rank(path, vocabulary, alphabet)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _by_rank(self, path: str, vocabulary: dict[str, int], alphabet: dict[str, int]) -> tiktoken.Encoding | None:
        """A quicker encoder of short parts, where the vocabulary's ids are in the order of its merges."""
        with open(path) as file:
            merges = [m if isinstance(m, list) else m.split(" ") for m in json.load(file)["model"]["merges"]]
        ids = [vocabulary["".join(m)] for m in merges]
        singles = [vocabulary.get(c, len(alphabet)) for c in alphabet]
        if ids != sorted(ids) or max(singles) >= min(ids) or len(vocabulary) != len(ids) + len(singles):
            return None
        ranks = {self.tokens[i]: i for i in vocabulary.values()}
        return tiktoken.Encoding("parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode_parts(self, parts: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Parts of Latin letters may take the quicker way: there the libraries' tables of letters agree."""
        slow = []
        for f in parts:
            if self.fast is None or max(f) >= LATIN_BELOW or f in self.special:
                slow.append(f)
            else:
                yield f, array("I", self.fast.encode_ordinary(f.decode())).tobytes()
        for f, e in zip(slow, self.library.encode_batch_fast([f.decode() for f in slow], add_special_tokens=False)):
            yield f, np.array(e.ids, "<u4").tobytes()

    def fragments(self, text: bytes) -> list[bytes]:
        """The parts between forced boundaries; joined they are the text."""
        if len(text) < 2:
            return [text] if text else []
        a = np.frombuffer(text, np.uint8)
        at = (np.flatnonzero(self.cut[(a[:-1].astype(np.uint16) << 8) | a[1:]]) + 1).tolist()
        return [text[i:j] for i, j in zip([0, *at], [*at, len(text)])]

    def segments(self, text: bytes) -> list[bytes]:
        """The text split at special tokens, which stay as parts of their own."""
        parts = [text]
        for mark in self.special:
            if mark in text:
                parts = [p for part in parts for p in self._split(part, mark)]
        return parts

    def _split(self, part: bytes, mark: bytes) -> Iterator[bytes]:
        if part in self.special:
            yield part
            return
        for k, piece in enumerate(part.split(mark)):
            if k:
                yield mark
            if piece:
                yield piece

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, as the library gives them without added tokens."""
        out: list[bytes] = []
        for part in chunks([len(t) for t in texts], CHUNK_BYTES):
            cut = [self._parts(t) for t in texts[part]]
            known = self._lookup({f for c in cut for f in c})
            out += [b"".join([known[f] for f in c]) for c in cut]
        return out

    def _parts(self, text: bytes) -> list[bytes]:
        parts = self.segments(text)
        if len(parts) == 1 and parts[0] not in self.special:
            return self.fragments(parts[0])
        return [f for p in parts for f in ([p] if p in self.special else self.fragments(p))]

    def _lookup(self, wanted: set[bytes]) -> dict[bytes, bytes]:
        young, old = self.young, self.old
        known, missing = {}, []
        for f in wanted:
            ids = young.get(f)
            if ids is None:
                ids = old.get(f)
                if ids is None:
                    missing.append(f)
                    continue
                young[f] = ids
            known[f] = ids
        for f, ids in self._encode_parts(missing):
            known[f] = ids
            if len(f) <= CACHED_BYTES:
                young[f] = ids
        if len(young) > CACHE_ENTRIES:
            self.old, self.young = young, {}
        return known

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 bytes of the decoded text; bytes that are no UTF-8 become replacement characters."""
        data = b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.decode("utf-8", "replace").encode()


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file, made once."""
    if path not in KEPT:
        KEPT[path] = Encoder(path)
    return KEPT[path]


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """`doc_id`, `ids` (array of long) and `decoded` text of every document.

    Null and empty texts have no ids and decode to the empty text; each row is encoded on its own, so repeated
    rows and ids give repeated results; an empty table gives no rows.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for part in chunks([len(t) for t in texts], 4 * CHUNK_BYTES):
                coded = codec.encode(texts[part])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part],
                        pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in coded], pa.list_(pa.int64())),
                        pa.array([codec.decode(x).decode() for x in coded], pa.string()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    return id_and_text(docs).mapInArrow(run, row_schema(docs, "ids array<bigint>, decoded string"))


def encode_digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Token count and SHA-256 digests of the ids and of the decoded text; the cases are those of `encode_documents`."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for part in chunks([len(t) for t in texts], 4 * CHUNK_BYTES):
                coded = codec.encode(texts[part])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part],
                        pa.array([len(x) // 4 for x in coded], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()),
                        pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in coded], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = row_schema(docs, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return id_and_text(docs).mapInArrow(run, schema)
