"""Token-id shards with keyed access.

A shard file holds, one after the other: the raw ids of its documents (2 or 4 bytes each, little-endian, by the
vocabulary's size); where each document starts, in tokens, and the end of the last; the documents' keys and
which of them are null; a minimal perfect hash over the distinct keys; and for each of its slots a fingerprint
of the key and the position of the first document that has it. A footer of fixed size says where each part is.
A key costs one hash, one slot, one fingerprint and one slice, however many documents there are.

Documents lie in ascending key order over all shards. A task writes its shard under a name of its own attempt and
reports it; the reports are written as a table, and only files named there belong to the store, so lost or
repeated attempts leave no trace in it. Files are written and read through pyarrow's file systems, in the
shared folder.

Defined results: a null or empty text is a document of the end token alone; null keys come first; rows that
share a key lie side by side, in the order of a hash of their texts, and a lookup gives all of them; an empty
table gives an empty store; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .memo import encoder, rank_order_suffices, texts_of, vocabulary_size
from .mph import PerfectHash, mix
from .shared import shared_path, whole_text, written

MAGIC = 0x31305344494B4F54
MANIFEST = "shard int, path string, documents long, tokens long, first_key long, last_key long, null_keys long"

#: Documents in a shard, on average; and shards in a block of the sums over the manifest.
SHARD_DOCUMENTS, _BLOCK = 8192, 1024


def _key_hash(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64), 7)


def _fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes, 31) >> np.uint64(32)).astype(np.uint32)


def write_store(docs: DataFrame, tokenizer: str, end_id: int, shard_documents: int = SHARD_DOCUMENTS) -> DataFrame:
    """Writes the shards of ``docs`` (doc_id, text); the manifest, a row for each shard."""
    spark = docs.sparkSession
    folder = shared_path(spark, "token-store")
    n_shards = max(1, -(-docs.select("doc_id").count() // shard_documents))
    width = 2 if vocabulary_size(tokenizer) <= 1 << 16 else 4
    by_rank = rank_order_suffices(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, task = encoder(tokenizer, width, by_rank).encode_all, np.array([end_id], f"<u{width}").tobytes(), TaskContext.get()
        shard, out, keys, sizes, path = task.partitionId(), None, [], [], ""
        for batch in batches:
            for key, found in zip(batch.column(0).to_pylist(), encode(texts_of(batch), width), strict=True):
                if out is None:
                    path = f"{folder}/shard-{shard:07d}-{task.taskAttemptId()}.ids"
                    files, at = pafs.FileSystem.from_uri(path)
                    files.create_dir(at.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(at, compression=None, buffer_size=1 << 20)
                ids = found + end
                out.write(ids)
                keys.append(key)
                sizes.append(len(ids) // width)
        if out is not None:
            known = [k for k in keys if k is not None]
            parts = _index(np.array(known, np.int64), len(keys), np.array(sizes, np.int64))
            offsets = [sum(sizes) * width]
            for part in parts:
                out.write(part)
                offsets.append(offsets[-1] + len(part))
            out.write(np.array([MAGIC, width, len(keys), *offsets], "<u8").tobytes())
            out.close()
            row = [shard, path, len(keys), sum(sizes), known[0] if known else None, known[-1] if known else None, len(keys) - len(known)]
            yield pa.RecordBatch.from_pylist([dict(zip(_MANIFEST_NAMES, row, strict=True))], schema=_MANIFEST_ARROW)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))
    sorted_ = rows.repartitionByRange(n_shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return written(sorted_.mapInArrow(run, MANIFEST), "manifest")


_MANIFEST_NAMES = ["shard", "path", "documents", "tokens", "first_key", "last_key", "null_keys"]
_MANIFEST_ARROW = pa.schema([("shard", pa.int32()), ("path", pa.string())] + [(n, pa.int64()) for n in _MANIFEST_NAMES[2:]])


def _index(known: np.ndarray, documents: int, sizes: np.ndarray) -> list[bytes]:
    """Starts, keys, perfect hash, fingerprints and positions. ``known``: the keys after the nulls, ascending."""
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")
    distinct, first = np.unique(known, return_index=True)
    hashes = _key_hash(distinct)
    table = PerfectHash.build(hashes)
    slots = table.slots(hashes)
    fingerprints, positions = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    fingerprints[slots] = _fingerprint(hashes)
    positions[slots] = first + (documents - len(known))
    return [starts.tobytes(), known.astype("<i8").tobytes(), table.to_bytes(), fingerprints.tobytes(), positions.tobytes()]


class Shard:
    """One shard file, opened for keyed access. The index is read whole, the payload only where it is asked for."""

    def __init__(self, path: str):
        files, at = pafs.FileSystem.from_uri(path)
        self.file = files.open_input_file(at)
        size, foot = self.file.size(), 8 * 9
        magic, self.width, self.documents, *ends = np.frombuffer(self.file.read_at(foot, size - foot), "<u8").astype(int).tolist()
        if magic != MAGIC:
            raise ValueError(f"not a shard of token ids: {path}")
        part = [self.file.read_at(b - a, a) for a, b in zip(ends, ends[1:], strict=False)]
        self.starts, known = np.frombuffer(part[0], "<i8"), np.frombuffer(part[1], "<i8")
        self.keys: list[int | None] = [None] * (self.documents - len(known)) + known.tolist()
        self.table = PerfectHash.from_bytes(part[2])
        self.fingerprints, self.positions = np.frombuffer(part[3], "<u4"), np.frombuffer(part[4], "<u4")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of the first document of each key; -1 where the fingerprint says that there is none."""
        hashes = _key_hash(keys)
        slots = self.table.slots(hashes)
        out = np.full(len(keys), -1, np.int64)
        held = np.flatnonzero(slots >= 0)
        good = held[self.fingerprints[slots[held]] == _fingerprint(hashes[held])]
        out[good] = self.positions[slots[good]]
        return out

    def ids(self, position: int) -> bytes:
        """The raw ids of the document at a position."""
        a, b = int(self.starts[position]), int(self.starts[position + 1])
        return self.file.read_at((b - a) * self.width, a * self.width)

    def get(self, key: int) -> list[bytes]:
        """The raw ids of every document with this key."""
        at, out = int(self.find(np.array([key], np.int64))[0]), []
        while 0 <= at < self.documents and self.keys[at] == key:
            out.append(self.ids(at))
            at += 1
        return out

    def close(self) -> None:
        self.file.close()


def _bases(manifest: DataFrame) -> DataFrame:
    """``manifest`` with ``base``, the tokens in all shards before: summed within blocks of shards, and over the blocks."""
    block = manifest.withColumn("block", F.floor(F.col("shard") / _BLOCK))
    totals = block.groupBy("block").agg(F.sum("tokens").alias("in_block"))
    ahead = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block of shards
    totals = totals.select("block", F.coalesce(F.sum("in_block").over(ahead), F.lit(0)).alias("before"))
    within = Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return block.join(totals, "block").withColumn("base", F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))


def read_store(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """A row for each document, from the files: key, first token over all shards, number of tokens, crc32 of the
    ids as 32-bit integers, and the ids themselves if asked for. Documents are found through the index."""
    shards = _bases(manifest).select("path", "base", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True):
                shard, seen = Shard(path), 0
                known = [k for k in shard.keys if k is not None]
                nulls = shard.documents - len(known)
                found = shard.find(np.array(known, np.int64))
                rows, repeat = [], 0
                for at, key in enumerate(shard.keys):
                    if key is None:
                        place = at
                    else:
                        repeat = repeat + 1 if at > nulls and shard.keys[at - 1] == key else 0
                        place = int(found[at - nulls]) + repeat
                    raw = shard.ids(place)
                    wide = raw if shard.width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()
                    rows.append((key, base + int(shard.starts[place]), len(wide) // 4, zlib.crc32(wide), wide if with_ids else None))
                    seen += len(wide) * with_ids
                    if len(rows) >= 10_000 or seen > 1 << 24:
                        yield _rows(rows)
                        rows, seen = [], 0
                shard.close()
                if rows:
                    yield _rows(rows)

    spread = shards.repartitionByRange(max(1, manifest.count()), "shard")  # a task for each shard; they are not merged by size
    out = spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    return out if with_ids else out.drop("ids")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def _routed(manifest: DataFrame, asked: DataFrame) -> DataFrame:
    """(path, shard, doc_id): the shards whose range of keys holds each asked key.

    A key lies in every shard that begins with it, which is a join, and in the last one that begins before it and ends with
    it or later. For that one, keys and shards are dealt out together by ranges and sorted, and the last shard seen is handed
    on; what stands before a range's first shard takes the last shard of the ranges before it, a row for each range.
    """
    shards = manifest.filter("first_key is not null").select("shard", "path", "first_key", "last_key")
    begun = asked.join(shards, asked["doc_id"] == shards["first_key"]).select("path", "shard", "doc_id")
    none = lambda kind: F.lit(None).cast(kind)
    both = shards.select(F.col("first_key").alias("key"), "shard", "path", "last_key")
    both = both.unionByName(asked.select(F.col("doc_id").alias("key"), none("int").alias("shard"), none("string").alias("path"), none("long").alias("last_key")))
    n = max(1, manifest.count())
    dealt = both.repartitionByRange(n, "key").sortWithinPartitions("key", F.asc_nulls_first("shard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), (None, None, None)
        for batch in batches:
            out = []
            for key, shard, path, last in zip(*(batch.column(c).to_pylist() for c in ("key", "shard", "path", "last_key")), strict=True):
                if shard is not None:
                    seen = (shard, path, last)
                elif seen[0] is None or seen[2] >= key:
                    out.append((part, key, *seen))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _SEEN, strict=True)], names=_SEEN_NAMES)
        if seen[0] is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, None, *seen), _SEEN, strict=True)], names=_SEEN_NAMES)

    found = written(dealt.mapInArrow(run, "part int, doc_id long, shard int, path string, last_key long"), "routes")
    ends = found.filter("doc_id is null").select(F.col("part").alias("end"), F.struct("shard", "path", "last_key").alias("at"))
    early = found.filter("doc_id is not null and shard is null")
    parts = early.select("part").distinct().select("part", F.col("part").alias("end"), F.lit(None).cast("struct<shard:int,path:string,last_key:bigint>").alias("at"))
    order = Window.orderBy("end", F.isnull("part")).rowsBetween(Window.unboundedPreceding, -1)  # a row or two for each range
    carried = ends.select(F.lit(None).cast("int").alias("part"), "end", "at").unionByName(parts)
    carried = carried.select("part", F.last("at", ignorenulls=True).over(order).alias("at")).filter("part is not null and at is not null")
    late = early.select("part", "doc_id").join(carried, "part").filter(F.col("at.last_key") >= F.col("doc_id")).select("at.path", "at.shard", "doc_id")
    held = found.filter("doc_id is not null and shard is not null").select("path", "shard", "doc_id")
    return begun.unionByName(held).unionByName(late)


_SEEN_NAMES, _SEEN = ["part", "doc_id", "shard", "path", "last_key"], [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64()]


def lookup(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """The ids of the documents that ``keys`` (doc_id) asks for: (doc_id, ids), a row for each asked row and document
    with that key. Keys go to the shards whose range holds them, and each shard is opened once for its keys."""
    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null")
    sent = _routed(manifest, asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, Shard] = {}
        for batch in batches:
            rows = []
            for path, key in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if path not in opened:
                    for old in opened.values():
                        old.close()
                    opened = {path: Shard(path)}
                rows += [(key, ids) for ids in opened[path].get(key)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([i for _, i in rows], pa.binary())], names=["doc_id", "ids"])

    spread = sent.repartitionByRange(max(1, manifest.count()), "shard").sortWithinPartitions("shard", "doc_id")
    return spread.mapInArrow(run, "doc_id long, ids binary")
