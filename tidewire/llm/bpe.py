"""Byte-level byte-pair encoding with a two-tier lookup, and decoding.

Tier one: a minimal perfect hash over the vocabulary, with the slots' byte strings beside it, resolves a whole
pre-token that is itself in the vocabulary. Tier two, for the others: the bytes stand in a linked list, and
a heap of neighbouring pairs by rank, leftmost first, merges them until no pair has a rank. The ids equal
those of the tiktoken library for the same ranks and pattern.

Defined results: a null or empty text has no ids; equal rows get equal ids; an empty table gives no rows; a
pre-token of any length is encoded whole, in time n log n; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memo import UnitEncoder, texts_of
from .mph import PerfectHash
from .shared import whole_text


def load_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ranks of a vocabulary file of the tiktoken library."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class TwoTierBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        words = list(ranks)
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        self.table = PerfectHash.build(hashes)
        self.slot_word: list[bytes] = [b""] * len(words)
        self.slot_rank = [0] * len(words)
        self.slot = self.table.one()
        for word, slot in zip(words, self.table.slots(hashes).tolist(), strict=True):
            self.slot_word[slot], self.slot_rank[slot] = word, ranks[word]
        self.word_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for word, rank in ranks.items():
            self.word_of[rank] = word
        self.units = UnitEncoder(self.unit)

    def unit(self, unit: str) -> bytes:
        """Ids of a text's part, each match of the pattern for itself, without the units' memory."""
        ids: list[int] = []
        for piece in self.split(unit):
            piece = piece.encode()
            slot = self.slot(xxhash.xxh3_64_intdigest(piece))
            if slot >= 0 and self.slot_word[slot] == piece:
                ids.append(self.slot_rank[slot])
            else:
                ids += self.merged(piece)
        return struct.pack(f"<{len(ids)}I", *ids)

    def merged(self, piece: bytes) -> list[int]:
        """Tier two. ``end[i]`` is the end of the part that starts at i, or 0 once it has gone into the one before."""
        n, ranks = len(piece), self.ranks
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of its parts has changed since
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (rank := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (rank, i, end[stop]))
            if (left := before[i]) >= 0 and (rank := ranks.get(piece[left:stop])) is not None:
                heapq.heappush(heap, (rank, left, stop))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.units.encode(text)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.word_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_MODELS: dict[tuple[str, str], TwoTierBpe] = {}


def model(path: str, pattern: str) -> TwoTierBpe:
    """This process's model of a vocabulary; a Python worker keeps it from task to task."""
    if (path, pattern) not in _MODELS:
        _MODELS[path, pattern] = TwoTierBpe(load_ranks(path), pattern)
    return _MODELS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """A row for each document: number of ids, digests of the ids and of the decoded bytes, and the ids if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path, pattern)
        for batch in batches:
            rows = []
            for ids in bpe.units.encode_all(texts_of(batch), 4):
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest(), ids if with_ids else None))
            if rows:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    out = rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary")
    return out if with_ids else out.drop("ids")
