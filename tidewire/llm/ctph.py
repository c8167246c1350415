"""Context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a chunk wherever its low bits are all ones, so boundaries depend
on what stands there and not on where it stands. Each chunk gives one character of a signature. The fingerprint
``block:signature:signature`` has the signatures for a block size, chosen by the text's length and halved while
too few chunks come out, and for its double. Two fingerprints are compared where they have a block size in common,
by the edit distance of those signatures: likeness 1 - distance / length of the longer one, the best of the
sizes in common; 0 without one. Equal texts have equal fingerprints.

Defined results: a null or empty text has two empty signatures, and is like another such text by 1 and like any
other by 0; a signature has a character for every chunk, however many a repetitive text has; a text is hashed in
parts of bounded size; repeated rows follow each other, and rows that share a doc_id come in the order of
their texts' XXH64; an empty table gives no rows; one row alone is its own next document; null doc_ids come last; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import whole_text, written

WINDOW, LEAST_BLOCK, WANTED = 7, 4, 64
_PART = 1 << 20
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def rolling(data: bytes) -> Iterator[np.ndarray]:
    """The hash of the window that ends at each byte, in parts."""
    for at in range(0, len(data), _PART):
        lead = min(at, WINDOW - 1)
        b = np.frombuffer(data, np.uint8, min(_PART, len(data) - at) + lead, at - lead).astype(np.uint32) + np.uint32(1)
        h = b.copy()
        for k in range(1, WINDOW):
            h[k:] += b[:-k] * np.uint32(pow(0x01000193, k, 1 << 32))
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        yield h[lead:]


def signature(parts: list[np.ndarray] | Iterator[np.ndarray], block: int) -> str:
    """A letter for each chunk: of the sum of the window hashes in it."""
    low, sums, open_ = np.uint32(block - 1), [], 0
    for h in parts:
        ends = np.flatnonzero((h & low) == low) + 1
        starts = np.concatenate([[0], ends])
        wide = h.astype(np.uint64)
        got = np.add.reduceat(wide, starts[starts < len(h)]).tolist() + [0] * int(starts[-1] == len(h))
        sums += [open_ + got[0], *got[1:]]
        open_ = sums.pop()
    if open_:
        sums.append(open_)
    return "".join(_LETTERS[(s * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 58] for s in sums)


def fingerprint(text: str) -> str:
    data = text.encode()
    parts = list(rolling(data)) if len(data) <= _PART else None
    again = lambda: parts if parts is not None else rolling(data)
    block = LEAST_BLOCK
    while block * WANTED < len(data):
        block *= 2
    own = signature(again(), block)
    double = signature(again(), 2 * block)
    while block > LEAST_BLOCK and len(own) < WANTED // 2:
        block, double = block // 2, own
        own = signature(again(), block)
    return f"{block}:{own}:{double}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein's distance; the columns of its table are kept as the bits of their differences. What both begin or end
    with costs nothing."""
    same = len(os.path.commonprefix([a, b]))
    a, b = a[same:], b[same:]
    same = len(os.path.commonprefix([a[::-1], b[::-1]]))
    a, b = a[: len(a) - same], b[: len(b) - same]
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    all_, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = all_, 0, len(a)
    for c in b:
        match = at.get(c, 0)
        zero = (((match & up) + up) ^ up) | match | down
        more, less = down | ~(zero | up) & all_, up & zero
        distance += bool(more & last) - bool(less & last)
        more = more << 1 & all_ | 1
        up, down = less << 1 & all_ | ~(zero | more) & all_, more & zero
    return distance


def likeness(a: str, b: str) -> float:
    """Of two fingerprints, from 0 to 1."""
    if a == b:
        return 1.0
    (block_a, *own_a), (block_b, *own_b) = a.split(":"), b.split(":")
    by_size = {int(block_a) << k: s for k, s in enumerate(own_a)}
    both = [(by_size[int(block_b) << k], s) for k, s in enumerate(own_b) if int(block_b) << k in by_size]
    return max((1 - edit_distance(x, y) / max(len(x), len(y)) for x, y in both if x or y), default=0.0)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the first as many code points (or all) of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _row(doc_id: int | None, text: str, own: str, following: str, next_own: str) -> tuple:
    changed = edited(text, following)
    changed_own = fingerprint(changed)
    return doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, changed_own, likeness(own, changed_own), likeness(own, next_own)


def neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text (see ``edited``; the following document is the next by
    descending doc_id, and the first after the last), and the likeness to the edited text's and the next one's.

    The documents are dealt out once, by ranges of doc_id. A range's last document waits for the first one of the
    next range; those two of each range are all that goes through a second, small join.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.repartitionByRange(n, F.desc("doc_id"), "tie").sortWithinPartitions(F.desc("doc_id"), "tie").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        edge: list[tuple] = []
        for batch in batches:
            out = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = value.as_py()
                own = fingerprint(text)
                if last is None:
                    edge.append((part, "first", text))
                else:
                    out.append((*_row(*last, text, own), None, None, None))
                last = (doc_id, text, own)
            if out:
                yield _edge_batch(out)
        if last is not None:
            yield _edge_batch([(None,) * 7 + edge[0], (last[0], None, None, last[2], None, None, None, part, "last", last[1])])

    wide = written(ranges.mapInArrow(run, f"{_COLUMNS}, part int, edge string, text string"), "neighbours")
    first = wide.filter("edge = 'first'").select("part", F.col("text").alias("following"))
    order = Window.orderBy("part")  # one row for each range
    parts = first.select("part").withColumn("next", F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy())))
    last = wide.filter("edge = 'last'").select("part", "doc_id", "text")
    pairs = last.join(parts, "part").join(first.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_row(d, t, fingerprint(t), f, fingerprint(f)) for d, t, f in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return wide.filter("edge is null").select(_SCHEMA.names).unionByName(pairs.mapInArrow(close, _COLUMNS))


_EDGE = pa.schema([*_SCHEMA, ("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())])


def _edge_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _EDGE, strict=True)], schema=_EDGE)
