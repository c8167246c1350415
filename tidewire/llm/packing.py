"""Best-fit packing with dominance reduction.

Documents become pieces of at most ``capacity`` tokens. The lengths of all pieces are counted in one
histogram of at most ``capacity`` rows, and the packing is planned on that histogram, so the plan's size does
not depend on the number of documents:

1. Dominance reduction after Martello and Toth. For a piece of length j let i be the longest other piece that
   fits beside it. If no two or more pieces fit into the room beside j with a sum above i, then {j, i} dominates
   every other sequence with j in it (whatever stood there could take i's place), and it is fixed for good.
   This holds above all where i fills the room exactly, and where no two pieces fit beside j. Otherwise, if no three
   pieces fit beside j, let b be the longest piece that fits beside j and i. If the shorter one of any two pieces that fit beside
   j is no longer than b, then {j, i, b} dominates (the longer one could take i's place and the shorter one b's).
2. The shrunken instance is packed best-fit, longest first, again by whole classes of equal lengths.

Each piece then gets its rank among the pieces of its length (counted per partition while encoding, so that no
row of a common length waits for another one), and the plan turns (length, rank) into a sequence and an offset.

Defined results: a null or empty text is a document of the end token alone; a null doc_id is kept as it is;
repeated rows are packed each for itself; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .memo import encoder, rank_order_suffices, texts_of
from .shared import released, whole_text, written

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: only what is longer than ``capacity`` is cut; the first piece may be shorter."""
    if n_tokens <= capacity:
        return [(0, n_tokens)]
    first = n_tokens % capacity
    starts = ([0] if first else []) + list(range(first, n_tokens, capacity))
    return [(s, first if s == 0 and first else capacity) for s in starts]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, at_once: int | None = None) -> DataFrame:
    """A row for each piece, with its partition and its rank there among the pieces of its length."""

    by_rank = rank_order_suffices(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, 4, by_rank).encode_all, np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, found in zip(batch.column(0).to_pylist(), encode(texts_of(batch), 4, at_once), strict=True):
                ids = memoryview(found + end)
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, seen[length]))
                    seen[length] += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW, strict=True)], names=_NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(released(run), PIECES)


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
_ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def _dominating_third(left: dict[int, int], sizes: list[int], j: int, i: int, room: int) -> int:
    """The length b such that {j, i, b} dominates every other sequence with j in it, or 0."""
    own = lambda s: left.get(s, 0) - (s == j)
    total = pieces_ = 0
    for s in sizes:
        n = min(own(s), 3 - pieces_)
        total, pieces_ = total + n * s, pieces_ + n
        if pieces_ == 3:
            break
    if pieces_ == 3 and total <= room:
        return 0  # three pieces fit beside j
    b = next((s for s in reversed(sizes) if s <= room - i and own(s) > (s == i)), 0)
    above = 0
    for y in reversed(sizes):  # the longest piece that has one at least as long beside it
        if y > room or own(y) <= 0:
            continue
        if own(y) > 1 and 2 * y <= room or above and y + above <= room:
            return b if y <= b else 0
        above = y
    return 0


def reduce_by_dominance(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Takes the dominating sequences out of ``left`` (length to count), and returns them with their counts."""
    fixed: list[tuple[tuple[int, ...], int]] = []
    sizes = sorted(s for s, n in left.items() if n)
    room_bits = (1 << (capacity + 1)) - 1
    one = two = added = 0  # bit sets of the sums of one or more, and of two or more pieces of the sizes added so far
    for j in reversed(sizes):
        room = capacity - j
        while added < len(sizes) and sizes[added] <= room:
            s = sizes[added]
            for _ in range(capacity // s):
                two, one = (two | one << s) & room_bits, (one | 1 << s | one << s) & room_bits
            added += 1
        while left[j]:
            i = next((s for s in range(min(room, sizes[-1]), 0, -1) if left.get(s, 0) > (s == j)), 0)
            if not i:
                fixed.append(((j,), left[j]))
                left[j] = 0
            elif two >> (i + 1) & ((1 << (room - i)) - 1):  # two or more pieces could fill more of the room than i does
                if not (b := _dominating_third(left, sizes, j, i, room)):
                    break
                need = Counter((j, i, b))
                n = min(left[s] // k for s, k in need.items())
                fixed.append(((j, i, b), n))
                for s, k in need.items():
                    left[s] -= n * k
            else:
                n = left[j] // 2 if i == j else min(left[j], left[i])
                fixed.append(((j, i), n))
                left[j] -= n
                left[i] -= n
    return fixed


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit of whole classes, longest first. Sequences as lists of (length, how many), and their counts."""
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = defaultdict(list)

    def put(room: int, held: list[tuple[int, int]], count: int, s: int, n: int) -> int:
        """Fills ``count`` like sequences with pieces of length s, each as far as it goes; what is left of n."""
        each = room // s
        full = min(count, n // each)
        rest = n - full * each if full < count else 0
        if full:
            open_[room - each * s].append(([*held, (s, each)], full))
        if rest:
            open_[room - rest * s].append(([*held, (s, rest)], 1))
        if (same := count - full - bool(rest)) and held:
            open_[room].append((held, same))
        return n - full * each - rest

    for s in sorted((s for s, n in left.items() if n), reverse=True):
        n = left[s]
        for room in sorted(r for r in open_ if r >= s):
            if not n:
                break
            groups = open_.pop(room)
            while groups:
                held, count = groups.pop()
                if n:
                    n = put(room, held, count, s, n)
                else:
                    open_[room].append((held, count))
        if n:
            put(capacity, [], -(-n // (capacity // s)), s, n)
    return [group for groups in open_.values() for group in groups]


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces a sequence, first sequence, offset), sorted; at most a few for each pair of lengths."""
    left = dict(histogram)
    groups = [([(s, 1) for s in fixed], n) for fixed, n in reduce_by_dominance(left, capacity)]
    groups += best_fit(left, capacity)
    rows, rank, sequence = [], defaultdict(int), 0
    for held, count in groups:
        offset = 0
        for s, each in held:
            rows.append((s, rank[s], each, sequence, offset))
            rank[s] += each * count
            offset += s * each
        sequence += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, at_once: int | None = None, rows_at_once: int | None = None) -> DataFrame:
    """Packs every document; a row for each piece, with its sequence and its offset there. Texts are encoded together up to
    ``at_once`` characters, and go to a worker ``rows_at_once`` rows at a time: fewer take less memory and more time."""
    cut_up = written(pieces(docs, tokenizer, capacity, end_id, at_once), "pieces", rows_at_once)
    counts = cut_up.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    steps = docs.sparkSession.sparkContext.broadcast(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut_up.join(bases, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = steps.value
        keys = table[:, 0] << 42 | table[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            row = table[np.searchsorted(keys, length << 42 | rank, side="right") - 1]
            behind = rank - row[:, 1]
            places = [row[:, 3] + behind // row[:, 2], row[:, 4] + behind % row[:, 2] * length]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, places)], names=[*_NAMES[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, PACKED)
