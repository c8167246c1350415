"""Quality by importance resampling.

Two generative models over hashed n-grams: one of target text (documents labelled good) and one of the raw text
(every document). An n-gram is a token or a pair of neighbouring tokens, a token a run of letters and digits
or a run of other marks; a pair's bucket hangs on the difference of its tokens' hashes, so all repeated tokens
share one. A document's log weight is the sum over its n-grams of the log ratio of the two models.

Sampling without replacement by Gumbel top-k: each document's log weight gets a Gumbel variate, drawn from a hash
of its doc_id, and the k largest sums are the sample. k is the expected number of documents from the target
distribution, the sum over all documents of min(1, share x weight), with the share of good labels. The k-th
sum is found exactly by counting in ever finer bins, so neither keys nor documents are gathered.

The raw model, the weights and k cover every document. The target model is fitted on at most ``sample`` labelled
documents, those with the smallest hashes of their doc_ids; it is the only bounded part.

Defined results: a null, empty or blank text has no n-grams and the log weight 0; a label is good if its quality is 1, and
a label without doc_id or quality does not count; rows that share a doc_id share their variate and each goes by its own
weight, so equal rows are taken or left together, as are all that tie with the last one taken; without good
labels every weight is 0 and the share 1, so every document is kept; an empty table gives no rows; other columns are not
read, and ``keep_target`` hands them on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .mph import mix
from .shared import released, scratch, whole_text, written

BUCKETS, SAMPLE, SEED = 1 << 12, 20_000, 20240
#: N-grams a bucket that the raw model lends to the target model, so that rare buckets weigh little.
LENT = 64
_PART = 1 << 19
_SPACE, _WORD, _MARK = 0, 1, 2
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = _WORD
_MIXED = mix(np.arange(256 * 32, dtype=np.uint64), 3).reshape(32, 256)


def ngram_buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of a text's n-grams, in parts of bounded size. A token that goes on in the next part is counted there, with
    all of its bytes, and so is the pair across two parts."""
    data, last = text.encode(), None
    kept, size, total = _SPACE, 0, np.zeros(0, np.uint64)  # the run that the part before ended in
    for at in range(0, len(data), _PART):
        b = np.frombuffer(data, np.uint8, min(_PART, len(data) - at), at)
        kind = _KIND[b]
        start = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
        sizes = np.diff(np.append(start, len(b)))
        place = np.arange(len(b)) - np.repeat(start, sizes)
        goes_on = size > 0 and kind[0] == kept
        if goes_on:
            place[: sizes[0]] += size
        token, kinds = np.add.reduceat(_MIXED[place & 31, b], start), kind[start]
        if goes_on:
            token[:1] += total
            sizes[0] += size
        elif size:
            token, kinds = np.concatenate([total, token]), np.concatenate([[kept], kinds])
        if at + len(b) < len(data):
            kept, size, total = kinds[-1], int(sizes[-1]), token[-1:]
            token, kinds = token[:-1], kinds[:-1]
        token = token[kinds != _SPACE]
        if not len(token):
            continue
        chain = token if last is None else np.concatenate([last, token])
        last = token[-1:]
        pairs = mix(chain[1:] - chain[:-1], 5)
        yield (np.concatenate([mix(token, 4), pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def bucket_counts(docs: DataFrame) -> DataFrame:
    """(bucket, n): n-grams of all documents; each task sends one row for each of its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for buckets in ngram_buckets(text.as_py()):
                    total += np.bincount(buckets, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return docs.select(whole_text().alias("text")).mapInArrow(released(run), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame) -> np.ndarray:
    out = np.zeros(BUCKETS)
    for row in counts.collect():  # at most BUCKETS rows
        out[row["bucket"]] = row["n"]
    return out


def log_ratios(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """The log ratio of target to raw for each bucket, and the share of good labels."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality is not null")
    n, good = known.agg(F.count("*"), F.count(F.when(F.col("quality") == 1, 1))).first()
    chosen = known.filter("quality = 1").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    target = _vector(bucket_counts(docs.join(F.broadcast(chosen), "doc_id", "left_semi")))  # at most `sample` ids
    raw = _vector(bucket_counts(docs))
    if not target.sum() or not n:
        return np.zeros(BUCKETS), 1.0
    raw = (raw + 1) / (raw.sum() + BUCKETS)
    target = (target + LENT * BUCKETS * raw) / (target.sum() + LENT * BUCKETS)
    return np.log(target) - np.log(raw), good / n


_WEIGHT = pa.struct([("n_grams", pa.int64()), ("log_weight", pa.float64()), ("key", pa.float64())])


def _weigh(ids: pa.Array, texts: pa.Array, ratio: np.ndarray, seed: int) -> list[pa.Array]:
    """Number of n-grams, log weight, and log weight with the document's Gumbel variate, of each row."""
    n, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for k, text in enumerate(texts):
        for buckets in ngram_buckets(text.as_py()):
            n[k] += len(buckets)
            total[k] += ratio[buckets].sum()
    numbers = ids.fill_null(-1).to_numpy().astype(np.int64)
    draw = (mix(numbers.view(np.uint64) ^ np.uint64(seed), 9) >> np.uint64(12)).astype(np.float64)
    gumbel = -np.log(-np.log((draw + 0.5) / (1 << 52)))
    # rounded, so that machines whose logarithms differ in the last bit agree
    return [pa.array(n), pa.array(total), pa.array(np.round(total + gumbel, 9))]


def weights(docs: DataFrame, ratios: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_grams, log_weight, key): key is the log weight with the document's Gumbel variate."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *_weigh(*batch.columns, sent.value, seed)], names=["doc_id", "n_grams", "log_weight", "key"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(released(run), "doc_id long, n_grams long, log_weight double, key double")


def weight_of(ratios: np.ndarray, spark: SparkSession, seed: int = SEED) -> Column:
    """The same as a column of a table with doc_id and text: a struct of n_grams, log_weight and key."""
    sent = spark.sparkContext.broadcast(ratios)

    @F.arrow_udf("struct<n_grams:bigint,log_weight:double,key:double>")
    def weigh(ids: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_weigh(ids, texts, sent.value, seed), fields=list(_WEIGHT))

    return weigh(F.col("doc_id").cast("long"), whole_text())


def kth_largest(rows: DataFrame, k: int, order: str = "key", bins: int = 4096, few: int = 10_000) -> float:
    """The k-th largest ``order``; infinite where none or all of the rows are wanted. The driver sees bin counts, and
    at the end at most ``few`` keys, or the one key that fills a bin."""
    low, high, n = rows.agg(F.min(order), F.max(order), F.count("*")).first()
    if k >= n or low is None:
        return -math.inf
    if k <= 0:
        return math.inf
    above = 0  # rows above `high`
    while True:
        inside = rows.filter((F.col(order) >= low) & (F.col(order) <= high))
        if n <= few or high <= low:
            if high > low:
                for key, n in sorted(inside.groupBy(F.col(order).alias("key")).count().collect(), reverse=True):  # at most `few` rows
                    if above + n >= k:
                        low = key
                        break
                    above += n
            return low
        step = (high - low) / bins
        if step <= 0 or low + step == low:
            return low
        bin_ = F.least(F.floor((F.col(order) - low) / step), F.lit(bins - 1)).alias("bin")
        found = inside.groupBy(bin_).agg(F.count("*").alias("n"), F.min(order).alias("low"), F.max(order).alias("high")).collect()  # at most `bins` rows
        for row in sorted(found, key=lambda r: -r["bin"]):
            if above + row["n"] >= k:
                low, high, n = row["low"], row["high"], row["n"]
                break
            above += row["n"]


def top_k(rows: DataFrame, k: int, order: str = "key", bins: int = 4096, few: int = 10_000) -> DataFrame:
    """The k rows with the largest ``order`` and those that tie with the last of them."""
    return rows.filter(F.col(order) >= kth_largest(rows, k, order, bins, few))


def _last_key(scored: DataFrame, share: float) -> float:
    """The last key of the sample: of as many rows as are to be expected from the target."""
    expected = F.least(F.lit(1.0), F.lit(share) * F.exp(F.least("log_weight", F.lit(50.0))))
    return kth_largest(scored, round(scored.agg(F.coalesce(F.sum(expected), F.lit(0.0))).first()[0]))


def resample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The sampled documents: doc_id, n_grams, log_weight, key."""
    ratios, share = log_ratios(docs, labels, sample)
    scored = written(weights(docs, ratios), "weights")
    return scored.filter(F.col("key") >= _last_key(scored, share))


def keep_target(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows that the sampling leaves out. Each row is weighed again where it stands and held against the
    last key of the sample, so no row is found again by its doc_id, and none is sent or copied."""
    ratios, share = log_ratios(docs, labels, sample)
    with scratch(docs.sparkSession):
        last = _last_key(written(weights(docs, ratios), "weights"), share)
    return docs.filter(weight_of(ratios, docs.sparkSession)["key"] >= last)
