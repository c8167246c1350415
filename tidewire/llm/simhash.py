"""SimHash near-duplicates with bit-sliced comparison.

A document's fingerprint has a bit for each bit of its shingles' hashes: 1 if the bit is set in over half of them.
Equal fingerprints make a class; two classes are linked if at most ``radius`` bits differ.

Candidates. A key is a group of fingerprint bits, and only classes with an equal key are compared. With
``block_keys`` the bits are cut into blocks and every choice of blocks is a key, so that at most ``radius``
differing bits leave at least one key equal: no link is lost.

Comparison. The classes of a key's bucket stand in rows, one after the other; bit planes hold one bit of many
rows each, 64 rows to a word. For each lag d the planes are compared with themselves d rows on, which gives one
bit of 64 distances with every instruction; carry-save counters add them up, and a block of rows is abandoned
once all its distances exceed the radius. Rows that are already in one component are no longer compared, and a
bucket gives a star for each component: fewer links than rows, with no link's effect lost.

A bucket of more than ``tile`` rows is dealt out in squares: its rows go to chunks by a hash, and each pair of
chunks is one tile, so that a hot bucket is spread over many tasks.

Components are found by alternating large and small stars, each round written to the shared folder.

Near copies. ``one_of_each_group`` goes by the overlap (Jaccard) of the sets of shingles, so its sketches are of sets:
256 independent hashes, and of each the least one in the set, which two sets share with a probability that is their
overlap, however many shingles there are and however often they are repeated. Bands of least hashes are the keys, and a
bit of each makes the planes. Equal sets make a class.

Exact check. Components that the sketches give are candidates only: within each of them the classes are compared once
more, now with their sets of shingles beside the planes, and a link holds if the sets' overlap reaches ``similarity``.
Each class goes there once (in tiles, where a component is large), or, in a large component whose keys give fewer pairs, once
for each of its keys.

Defined results: a null, empty or blank text has the fingerprint zero (in ``one_of_each_group``, the empty set) and is
linked like any other; a text of
fewer words than a shingle has one shingle, its words; repeated rows fall into one class; an empty table gives
no rows; other columns are not read, and ``one_of_each_group`` hands them on. Texts of one wide fingerprint are one class
there, and the text of its smallest doc_id stands for them.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mph import mix
from .shared import TEXTS_AT_ONCE, join_small, released, row_key, settled, whole_text, with_sums, without_rows, written

SEED = 42
#: Rows of a bucket that one task compares with each other.
TILE = 4096
#: The same where the rows bring their shingles along.
EXACT_TILE = 512
#: Bytes of shingles that a tile's half may have on average.
EXACT_BYTES = 8 << 20
_CHUNK = 1 << 14
#: Words of a plane, over all lags, that are compared at once; and shingles that are numbered at once.
_WORDS, _MARKED = 1 << 12, 1 << 19
#: Shingles that are hashed at once for a sketch, and bytes of a set's digest.
_HASHED, _DIGEST = 256, 16
#: Texts that are sketched at once.
_SKETCHED = 512


def shingle_hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """XXH64 of each run of so many words, in parts of bounded size. A-Z in lower case; ASCII white space parts words."""
    own = text.encode().lower().split()
    if not own:
        return
    if len(own) < words:
        own, words = [b" ".join(own)], 1
    hash_, join = xxhash.xxh64_intdigest, b" ".join
    for a in range(0, len(own) - words + 1, _CHUNK):
        part = own[a : a + _CHUNK + words - 1]
        yield np.array([hash_(join(s), SEED) for s in zip(*(part[k:] for k in range(words)), strict=False)], np.uint64)


def fingerprint(text: str, words: int, lanes: int = 1) -> np.ndarray:
    """``lanes`` words of 64 bits. The first lane takes the shingles' hashes, each further one a mix of them."""
    total, n = np.zeros(64 * lanes, np.int64), 0
    for hashes in shingle_hashes(text, words):
        wide = np.stack([hashes, *(mix(hashes, lane) for lane in range(1, lanes))], axis=1) if lanes > 1 else hashes[:, None]
        bits = np.unpackbits(wide.view(np.uint8).reshape(len(hashes), 8 * lanes), axis=1, bitorder="little").view(np.uint64)
        sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)  # eight counts of a byte each in a word, none above 255
        total += sums.view(np.uint8).reshape(len(sums), -1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return np.packbits(2 * total > n, bitorder="little").view(np.uint64)


def _bytes(fp: np.ndarray) -> bytes:
    """A fingerprint's bytes, the highest first."""
    return fp[::-1].astype(">u8").tobytes()


def fingerprints(docs: DataFrame, words: int = 3, lanes: int = 1) -> DataFrame:
    """(doc_id, fp): a row for each row of ``docs``; fp as bytes, the highest byte first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_bytes(fingerprint(t.as_py(), words, lanes)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(released(run), "doc_id long, fp binary")


def block_keys(bits: int, radius: int, chosen: int) -> list[int]:
    """Bit masks: ``radius + chosen`` blocks, and each choice of ``chosen`` of them."""
    blocks = radius + chosen
    edges = [bits * k // blocks for k in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(masks, chosen)]


def shingle_set(text: str, words: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(text, words)]))


def _set_digest(held: np.ndarray) -> bytes:
    return hashlib.blake2b(held.astype("<u8").tobytes(), digest_size=_DIGEST).digest()


def least_hashes(held: np.ndarray, n: int) -> np.ndarray:
    """Of each of ``n`` hashes (32 bits) the least one in a set; all ones for the empty set."""
    factor = mix(np.arange(n, dtype=np.uint64), 3)
    add, factor = (factor >> np.uint64(32)).astype(np.uint32)[:, None], (factor | np.uint64(1)).astype(np.uint32)[:, None]
    low, least = held.astype(np.uint32), np.full(n, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(low), _HASHED):
        h = low[a : a + _HASHED] * factor
        h += add
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        np.minimum(least, h.min(axis=1), out=least)
    return least


def sketches(docs: DataFrame, words: int, lanes: int, bands: int, width: int) -> DataFrame:
    """(id, fp, keys): a row for each row of ``docs`` (id, text); fp is a bit of each of the ``64 * lanes`` least hashes with
    the digest of the set behind them, and keys has one for each band of ``width`` least hashes."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _SKETCHED):
                batch = whole.slice(at, _SKETCHED)
                sets = [shingle_set(t.as_py(), words) for t in batch.column(1)]
                least = np.stack([least_hashes(s, 64 * lanes) for s in sets]).astype(np.uint64)
                bits = np.packbits((mix(least, 4) & np.uint64(1)).astype(bool), axis=1)
                fps = [b.tobytes() + _set_digest(s) for b, s in zip(bits, sets, strict=True)]
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sets), bands))
                for k in range(width):
                    key = mix(key ^ least[:, k : bands * width : width], 5)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), pa.array(key.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.binary()), keys], names=["id", "fp", "keys"])

    return docs.select("id", "text").mapInArrow(released(run), f"id {kind}, fp binary, keys array<long>")


def _shared_keys(classes: DataFrame) -> DataFrame:
    """(key, fp) for each of the ``keys`` of ``classes`` that others have too. The long fingerprints are sent only then."""
    entries = classes.select(F.explode("keys").alias("key"), F.xxhash64("fp").alias("number"))
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    entries = written(entries.join(shared, "key", "left_semi"), "shared-keys")
    return written(entries.join(classes.select(F.xxhash64("fp").alias("number"), "fp"), "number").select("key", "fp"), "key-entries")


def _lanes(masks: list[int], lanes: int) -> np.ndarray:
    return np.array([[m >> 64 * k & 0xFFFFFFFFFFFFFFFF for k in range(lanes)] for m in masks], np.uint64)


def _matrix(column: pa.Array, lanes: int) -> np.ndarray:
    """Fingerprints as rows of words, the lowest word first; what stands behind them does not count."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(len(column), -1)[:, :lanes][:, ::-1]


def _pack(flags: np.ndarray) -> np.ndarray:
    """Bits of each line of rows, 64 rows to a word."""
    spare = [(0, 0)] * (flags.ndim - 1) + [(0, -flags.shape[-1] % 64)]
    return np.packbits(np.pad(flags, spare), axis=-1, bitorder="little").view(np.uint64)


class Planes:
    """The bit planes of a block of rows."""

    def __init__(self, rows: np.ndarray):
        bits = np.unpackbits(np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        bits = np.pad(bits, ((0, -len(rows) % 64), (0, 0)))
        planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)
        self.words = planes.shape[1]
        self.planes = np.pad(planes, ((0, 0), (0, self.words + 1)))  # no row stands behind the last one

    def within(self, first: int, radius: int, asked: np.ndarray) -> np.ndarray:
        """``asked`` has a packed line of rows for each lag from ``first``, or one line for that lag alone. Of these rows,
        those that differ from the row so many on in at most ``radius`` bits."""
        depth = radius.bit_length()
        # counters start so that they overflow with the bit after the last one allowed
        ahead = (1 << depth) - 1 - radius
        at = np.flatnonzero(asked)
        alive = asked.ravel()[at]
        lag, word = np.divmod(at, self.words)
        far, shift = np.divmod(first + lag, 64)
        far, low = far + word, shift.astype(np.uint64)
        high = np.uint64(63) - low
        counters = np.empty((depth, len(at)), np.uint64)
        for c in range(depth):
            counters[c] = 0xFFFFFFFFFFFFFFFF if ahead >> c & 1 else 0
        for k, plane in enumerate(self.planes):
            carry = plane[word] ^ (plane[far] >> low | plane[far + 1] << np.uint64(1) << high)
            for counter in counters:
                both = counter & carry
                counter ^= carry
                carry = both
            alive &= ~carry
            if k % 16 == 15:
                live = np.flatnonzero(alive)
                if 2 * len(live) <= len(alive):  # the abandoned blocks go
                    at, alive, word, far, low, high = (x[live] for x in (at, alive, word, far, low, high))
                    counters = counters[:, live]
                if not len(live):
                    break
        out = np.zeros(asked.size, np.uint64)
        out[at] = alive
        return out.reshape(asked.shape)


def star_links(
    rows: np.ndarray, bucket: np.ndarray, radius: int, holds: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None
) -> list[tuple[int, int]]:
    """Links (row, first row of its component) within each bucket. Rows of one bucket stand together. A link counts only if
    it ``holds``, where that is given: it takes the rows of many links and tells which of them do."""
    n = len(rows)
    root = np.arange(n)

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    own, d, planes = np.arange(n), 1, None
    while len(own) > d:
        if planes is None or d & (d - 1) == 0:  # at each power of two: only buckets with more rows than d
            _, inverse, sizes = np.unique(bucket[own], return_inverse=True, return_counts=True)
            own = own[sizes[inverse] > d]
            if not len(own):
                break
            planes, held = Planes(rows[own]), bucket[own]
        # several lags at once, up to the next power of two
        lags = min(max(1, _WORDS // planes.words), (1 << d.bit_length()) - d, len(own) - d)
        tops = root[own]
        asked = np.zeros((lags, len(own)), bool)
        for k in range(lags):
            e = d + k
            asked[k, : len(own) - e] = (held[:-e] == held[e:]) & (tops[:-e] != tops[e:])
        if asked.any():
            near = planes.within(d, radius, _pack(asked))
            lag, a = np.nonzero(np.unpackbits(near.view(np.uint8), axis=1, bitorder="little"))
            a, b = own[a], own[a + d + lag]
            if holds is not None and len(a):
                kept = holds(a, b)
                a, b = a[kept], b[kept]
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                x, y = top(i), top(j)
                if x != y:
                    root[max(x, y)] = min(x, y)
            if len(a):
                while (root[root] != root).any():
                    root = root[root]
        d += lags
    return [(i, int(root[i])) for i in np.flatnonzero(root != np.arange(n)).tolist()]


def overlap_reaches(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the overlap (Jaccard) of two sets, given as sorted arrays, is at least ``similarity``."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if len(a) + 1e-9 < similarity * len(b):
        return False
    common = int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a)) if len(a) else 0
    return common + 1e-9 >= similarity * (len(a) + len(b) - common)


def overlaps_reach(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """The same for many pairs of ``sets``, by their places. Each set on the left is marked once for all its partners."""
    used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    sizes = np.array([len(sets[i]) for i in used.tolist()], np.int64)
    if sizes.sum() > _MARKED:  # too many to number at once
        if len(a) == 1:
            return np.array([overlap_reaches(sets[int(a[0])], sets[int(b[0])], similarity)])
        half = len(a) // 2
        return np.concatenate([overlaps_reach(sets, a[:half], b[:half], similarity), overlaps_reach(sets, a[half:], b[half:], similarity)])
    _, number = np.unique(np.concatenate([sets[i] for i in used.tolist()]), return_inverse=True)
    numbers = np.split(number, np.cumsum(sizes)[:-1])
    left, right = place[: len(a)], place[len(a) :]
    marks, common = np.zeros(len(number) + 1, bool), np.zeros(len(a), np.int64)
    order = np.argsort(left, kind="stable")
    for pairs in np.split(order, np.flatnonzero(np.diff(left[order])) + 1):
        own, others = numbers[left[pairs[0]]], right[pairs]
        marks[own] = True
        held = sizes[others] > 0  # an empty set has nothing in common with any
        if held.any():
            at = np.concatenate([[0], np.cumsum(sizes[others[held]])[:-1]])
            common[pairs[held]] = np.add.reduceat(marks[np.concatenate([numbers[j] for j in others[held].tolist()])], at, dtype=np.int64)
        marks[own] = False
    return common + 1e-9 >= similarity * (sizes[left] + sizes[right] - common)


def class_links(classes: DataFrame, masks: list[int], lanes: int, radius: int, tile: int = TILE) -> DataFrame:
    """(a, b): links between fingerprints that join what is linked; ``classes`` (fp) has each fingerprint once."""
    words = _lanes(masks, lanes)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps = batch.column(0).slice(at, 4096)
                rows = _matrix(fps, lanes)
                for k, mask in enumerate(words):
                    key = np.full(len(rows), k + 1, np.uint64)
                    for lane in np.flatnonzero(mask):
                        key = mix((rows[:, lane] & mask[lane]) ^ mix(key, int(lane) + 2), 1)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), fps], names=["key", "fp"])

    return key_links(written(classes.mapInArrow(released(keys), "key long, fp binary"), "keys"), lanes, radius, tile)


def key_links(entries: DataFrame, lanes: int, radius: int, tile: int = TILE) -> DataFrame:
    """The same from ``entries`` (key, fp), a written table: only fingerprints with an equal key are compared."""
    sizes = written(entries.groupBy("key").agg(F.count("*").alias("n"), F.count("*").alias("size")).filter("n > 1"), "simhash-buckets")
    return _tiled_links(entries, sizes, lanes, radius, tile)


def _buckets(members: DataFrame, entries: DataFrame | None, tile: int) -> DataFrame:
    """(row, fp, key): what is to be compared, for ``members`` (row, fp, root). A component is one bucket; one of more than ``tile``
    classes is compared by the keys of ``entries`` (key, fp) instead, if those buckets have fewer pairs: a long chain."""
    members = written(members.select("row", "fp", "root"), "near-members")
    whole = members.select("row", "fp", F.xxhash64("root").alias("key"))
    n = written(members.groupBy("root").agg(F.count("*").alias("n"), F.count("*").alias("size")), "near-roots")
    if entries is None or n.filter(F.col("n") > tile).isEmpty():
        return whole
    large = with_sums(members, n, "root").filter(F.col("size") > tile).select("row", "fp", "root", "size")
    bucket = F.xxhash64("root", "key").alias("bucket")
    held = written(entries.join(large, "fp").select("row", "fp", "root", "size", bucket), "near-keys")
    sums = written(held.groupBy("bucket").agg(F.count("*").alias("n"), F.count("*").alias("m"), F.first("root").alias("of"), F.first("size").alias("all")), "near-key-sums")
    pairs = F.sum(F.col("m").cast("double") * (F.col("m") - 1))
    fewer = written(sums.groupBy(F.col("of").alias("root")).agg(pairs.alias("pairs"), F.first("all").alias("all")).filter("pairs < cast(all as double) * (all - 1)").select("root"), "near-chains")
    by_key = with_sums(join_small(held, fewer, ["root"], "left_semi"), sums.select("bucket", "n", "m"), "bucket").filter("m > 1")
    by_root = join_small(members, fewer, ["root"], "left_anti").select("row", "fp", F.xxhash64("root").alias("key"))
    return by_root.unionByName(by_key.select("row", "fp", F.col("bucket").alias("key")))


def exact_links(
    texts: DataFrame, members: DataFrame, words: int, lanes: int, radius: int, similarity: float, tile: int = EXACT_TILE, tile_bytes: int = EXACT_BYTES,
    entries: DataFrame | None = None,
) -> DataFrame:
    """(a, b): links between the classes ``members`` (fp, root, row) of one component whose shingles overlap by
    ``similarity``; ``texts`` (row, text) has the text of each class, ``entries`` (key, fp) their keys. A tile has so many rows
    and, on average, at most so many bytes of shingles."""
    members = written(_buckets(members, entries, tile), "near-buckets")
    # the narrowest table there is picks the texts, before any is sent: a hash of each row's key; the join with the keys follows
    asked = written(members.select(F.xxhash64("row").alias("asked")).distinct(), "near-asked")
    texts = texts.withColumn("asked", F.xxhash64("row")).join(asked, "asked", "left_semi").select("row", "text").dropDuplicates(["row"])
    kind = texts.schema["row"].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = [shingle_set(t.as_py(), words).astype("<u8").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shingles, pa.binary())], names=["row", "shingles"])

    entries = texts.mapInArrow(released(sets), f"row {kind}, shingles binary").join(members, "row").select("key", "fp", "shingles")
    entries = written(entries, "near-sets", TEXTS_AT_ONCE)
    weight = F.greatest(F.count("*") / tile, F.sum(F.length("shingles").cast("long")) / tile_bytes) * tile
    sizes = entries.groupBy("key").agg(F.count("*").alias("n"), weight.alias("size"))
    return _tiled_links(entries, written(sizes, "near-sizes"), lanes, radius, tile, similarity)


def _tiled_links(entries: DataFrame, sizes: DataFrame, lanes: int, radius: int, tile: int, similarity: float | None = None) -> DataFrame:
    """(a, b): links between the rows of ``entries`` (key, fp, and shingles for the exact check) with an equal key, each
    bucket of ``sizes`` (key, n, size) dealt out in tiles of ``tile`` by its size."""
    chunks = F.ceil(F.col("size") / tile).cast("int")
    held = with_sums(entries, sizes, "key").filter("size is not null").select(*entries.columns, chunks.alias("g"), F.pmod(F.xxhash64("fp"), chunks).cast("int").alias("c"))
    other = F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("o")
    tiles = held.select(*entries.columns, "c", other).select(*entries.columns, F.least("c", "o").alias("t1"), F.greatest("c", "o").alias("t2"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table])
            marks = _marks(table)
            whole = int(np.flatnonzero(marks[1:] != marks[:-1])[-1]) + 1 if (marks[1:] != marks[:-1]).any() else 0
            left = table.slice(whole).combine_chunks()
            yield from links(table.slice(0, whole), marks[:whole])
        if left is not None:
            yield from links(left, _marks(left))

    def _marks(table: pa.Table) -> np.ndarray:
        parts = [table.column(n).to_numpy().astype(np.int64) for n in ("key", "t1", "t2")]
        new = np.zeros(table.num_rows, np.int64)
        for p in parts:
            new[1:] |= p[1:] != p[:-1]
        return np.cumsum(new)

    def links(table: pa.Table, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
        if table.num_rows < 2:
            return
        fps = table.column("fp").combine_chunks()
        holds = None
        if similarity is not None:
            sets = [np.frombuffer(x.as_buffer(), "<u8") for x in table.column("shingles").combine_chunks()]
            holds = lambda a, b: overlaps_reach(sets, a, b, similarity)
        found = star_links(_matrix(fps, lanes), bucket, radius, holds)
        if found:
            a, b = (pa.array([x[k] for x in found]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([fps.take(a), fps.take(b)], names=["a", "b"])

    dealt = tiles.repartition("key", "t1", "t2").sortWithinPartitions("key", "t1", "t2", "fp")
    return dealt.mapInArrow(released(compare), "a binary, b binary").distinct()


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) with m, the least neighbour of a. A star's centre stays where its edges are (see ``with_sums``)."""
    return with_sums(edges, written(edges.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("m")), "least"), "a")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node points at one other, and none that is pointed at points itself: then the centres are the roots."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("points")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("points")))
    return ends.groupBy("node").agg(F.sum("points").alias("n"), F.min("points").alias("least")).filter("n > 1 or (n = 1 and least = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of each linked node's component. A round's tables go with the next round's, and the
    rounds end when stars are left."""
    spark = links.sparkSession
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")

    def large() -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        return _with_least(both).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).filter("a <> b").distinct()

    def small() -> DataFrame:
        stars = written(large(), "large-stars")
        down = stars.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        turned = _with_least(down).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        return turned.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    while not _are_stars(edges):
        edges = settled(spark, small, "small-stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _rooted(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """``classes`` with the root of each one's component, null for a class without links."""
    members = roots.select(F.col("node").alias("fp"), "root").unionByName(roots.select(F.col("root").alias("fp"), "root").distinct())
    return classes.join(members, "fp", "left")


def near_components(
    classes: DataFrame, links: Callable[[DataFrame], DataFrame], check: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """(fp, component_id, class_id, class_size) for each of ``classes`` (fp, class_id, class_size): the smallest class_id
    that its links reach. ``links`` takes the classes and gives their links (a, b); ``check`` takes the linked classes
    (fp, class_id, root) and gives the links that hold."""
    found = links(classes)
    classes = classes.select("fp", "class_id", "class_size")
    rooted = written(_rooted(classes, components(found)), "rooted")
    if check is not None:
        rooted = written(_rooted(classes, components(check(rooted.filter("root is not null")))), "rooted")
    linked = rooted.filter("root is not null")
    least = written(linked.groupBy("root").agg(F.count("*").alias("n"), F.min("class_id").alias("component_id")), "least-classes")
    alone = rooted.filter("root is null").select("fp", F.col("class_id").alias("component_id"), "class_id", "class_size")
    return with_sums(linked, least, "root").select(alone.columns).unionByName(alone)


def simhash_components(docs: DataFrame, words: int = 3, radius: int = 3, chosen: int = 2) -> DataFrame:
    """doc_id, fingerprint (hexadecimal, 64 bits), component_id, class_id, class_size for each row of ``docs``."""
    found = written(fingerprints(docs, words), "fingerprints")
    classes = written(found.groupBy("fp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")), "classes")
    links = lambda own: class_links(own.select("fp"), block_keys(64, radius, chosen), 1, radius)
    grouped = written(near_components(classes, links).withColumn("n", F.col("class_size")), "components")
    return with_sums(found, grouped, "fp").select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id", "class_id", "class_size")


def one_of_each_group(
    docs: DataFrame, words: int = 5, lanes: int = 4, radius: int = 54, similarity: float = 0.8, bands: int = 40, width: int = 4
) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates, the one with the smallest doc_id.

    Two texts whose shingles overlap by 0.8 (Jaccard) have no equal band in (1 - 0.8 ** 4) ** 40, 1 of 10 ** 9 cases, and
    differ in 0.1 of their sketches' bits: 26 of 256, with a deviation of 5; more than the radius allows in 1 of 10 ** 7
    cases. That holds for texts of any length. Unrelated texts differ in 128 bits, with a deviation of 8. What the radius
    lets in below ``similarity`` the exact check turns away.

    Only equal sets of shingles are one class without that check. A row goes by its key (doc_id and 128 bits of hashes of its
    text, see ``row_key``), in one join with a narrow table: other texts of its doc_id stay. Rows without a doc_id come after all others; of several with one
    doc_id the one with the least XXH64 of its text stays, and one of several equal ones.
    """
    key = row_key()
    texts = docs.select(key.alias("row"), whole_text().alias("text"))

    def told() -> DataFrame:
        found = written(sketches(texts.withColumnRenamed("row", "id"), words, lanes, bands, width), "sketches", TEXTS_AT_ONCE)
        classes = found.groupBy("fp").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"), F.first("keys").alias("keys"))
        classes = written(classes, "classes")
        entries = _shared_keys(classes)
        links = lambda _: key_links(entries, lanes, radius)
        check = lambda linked: exact_links(texts, linked.select("fp", "root", F.col("class_id").alias("row")), words, lanes, radius, similarity, entries=entries)
        grouped = near_components(classes, links, check)
        near = grouped.filter((F.col("component_id") != F.col("class_id")) | (F.col("class_size") > 1))
        near = written(near.select("fp", F.col("component_id").alias("stays"), F.col("class_size").alias("n")), "near-classes")
        rows = with_sums(found.select("fp", "id"), near, "fp").filter("stays is not null")
        rows = rows.groupBy("id").agg(F.count("*").alias("n"), F.max(F.col("id") == F.col("stays")).alias("kept"))
        return rows.filter("n > 1 or not kept")

    return without_rows(docs, settled(docs.sparkSession, told, "near-rows"), key)
