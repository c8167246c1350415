"""The corpus operators against brute force on small tables, with nulls, empty and long texts, repeated rows and clashing columns."""

import base64
import gzip
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewire.llm import bpe, ctph, length_histogram, licenses, packing, quality, queries, radix_dedup, simhash, token_store, warc

BYTE, WORD, RANKS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, part int, kept string, key string, fp string, n_chars long"


def corpus(seed=1, n=60):
    draw = random.Random(seed)
    words = "the of and ein der Être ñu Ha stupid MIT license 42 x1 ## !! Über".split()
    rows = [" ".join(draw.choices(words, k=draw.choice([1, 3, 8, 40, 300]))) for _ in range(n)]
    base = " ".join(f"w{k}" for k in range(400))
    rows += [base, base.replace("w7 ", "w7x "), base.upper(), base + " ", "A", "a", "", None, None, " \t\n", "x" * 30_000, "Released under the MIT License.\nmore text here"]
    rows += [rows[0], rows[0], rows[1].swapcase()]
    return [(k, t, "en", 1, "y", "k", "f", 0) for k, t in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def repeated(spark):
    """A row twice, and one without an id twice."""
    return spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "q"), (None, "q"), (None, "Z")], "doc_id long, text string")


# --- packing


def test_sets_of_three_are_fixed():
    left = {60: 2, 25: 2, 15: 2, 14: 2}
    assert packing.reduce_by_dominance(left, 100)[0] == ((60, 25, 15), 2)
    assert packing._dominating_third({60: 1, 25: 1, 15: 1, 14: 1}, [14, 15, 25, 60], 60, 25, 40) == 15
    assert packing._dominating_third({60: 1, 22: 1, 20: 2, 14: 1}, [14, 20, 22, 60], 60, 22, 40) == 0  # 20 and 20 would fill the room
    assert packing._dominating_third({60: 1, 25: 1, 13: 3}, [13, 25, 60], 60, 25, 40) == 0  # three pieces fit


def test_packing_is_whole(spark, docs, rows):
    library = Tokenizer.from_file(BYTE)
    found = packing.pack(docs, BYTE, 64).collect()
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc_id, text, *_ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(len(parts)))
        assert [p["start"] for p in parts] == [0, *np.cumsum([p["length"] for p in parts])[:-1]]
        assert sum(p["length"] for p in parts) == len(ids)
        assert len(ids) > 64 or len(parts) == 1
        assert all(p["length"] == 64 for p in parts[1:])
        for p in parts:
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in parts] == [0, *np.cumsum([p["length"] for p in parts])[:-1]]
        assert sum(p["length"] for p in parts) <= 64


def fewest(lengths, capacity):
    """The least number of bins, by trying all."""
    best = len(lengths)

    def put(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i in sorted({b: i for i, b in enumerate(bins)}.values()):
            if bins[i] + lengths[k] <= capacity:
                put(k + 1, [*bins[:i], bins[i] + lengths[k], *bins[i + 1 :]])
        put(k + 1, [*bins, lengths[k]])

    put(0, [])
    return best


@pytest.mark.parametrize("seed", range(300))
def test_dominance_keeps_the_optimum(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 17, 30])
    lengths = sorted((draw.randint(1, capacity) for _ in range(draw.randint(1, 9))), reverse=True)
    left = {s: lengths.count(s) for s in set(lengths)}
    fixed = packing.reduce_by_dominance(left, capacity)
    rest = sorted((s for s, n in left.items() for _ in range(n)), reverse=True)
    assert sum(n for _, n in fixed) + fewest(rest, capacity) == fewest(lengths, capacity)
    assert all(sum(p) <= capacity for p, _ in fixed)
    bins = packing.best_fit(dict(left), capacity)
    assert sorted((s for held, n in bins for s, m in held for _ in range(n * m)), reverse=True) == rest
    assert all(sum(s * m for s, m in held) <= capacity for held, _ in bins)


# --- quality


def test_quality_buckets_do_not_hang_on_parts(monkeypatch):
    text = "Some words, and more!! words ### é " * 50
    whole = np.sort(np.concatenate(list(quality.ngram_buckets(text))))
    monkeypatch.setattr(quality, "_PART", 97)
    assert (np.sort(np.concatenate(list(quality.ngram_buckets(text)))) == whole).all()


def test_quality_weights_and_top_k(spark, docs, rows):
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0, "x") for k in range(40)] + [(None, 1, 0, "x"), (5, None, 0, "x")], "doc_id long, quality int, toxic int, text string")
    ratios, share = quality.log_ratios(docs, labels)
    assert 0 < share < 1
    count = lambda keep: sum((np.bincount(b, minlength=quality.BUCKETS) for k, t, *_ in rows if keep(k) for b in quality.ngram_buckets(t or "")), np.zeros(quality.BUCKETS))
    raw, target = count(lambda k: True), count(lambda k: k < 40 and k % 3 > 0)
    p = (raw + 1) / (raw.sum() + quality.BUCKETS)
    q = (target + quality.LENT * quality.BUCKETS * p) / (target.sum() + quality.LENT * quality.BUCKETS)
    assert np.allclose(ratios, np.log(q / p))
    scored = quality.weights(docs, ratios).cache()
    for r in scored.collect():
        expected = sum(ratios[b].sum() for b in quality.ngram_buckets(rows[r["doc_id"]][1] or ""))
        assert r["log_weight"] == pytest.approx(expected)
    keys = sorted((r["key"] for r in scored.collect()), reverse=True)
    for k in (0, 1, 7, 40, len(keys), 999):
        found = sorted((r["key"] for r in quality.top_k(scored, k, bins=4, few=2).collect()), reverse=True)
        assert found == keys[: max(k, 0)]


def test_quality_tokens_go_on_over_parts():
    draw = random.Random(9)
    assert sum(map(len, quality.ngram_buckets("ab" * 300_000))) == 1
    assert sum(map(len, quality.ngram_buckets("ab" * 300_000 + " " + "!" * 700_000))) == 3
    text = "".join(draw.choices("ab1é !?\n", k=2000))
    assert sorted(b for part in quality.ngram_buckets(text) for b in part.tolist()) == sorted(plain_buckets(text))


_LOW = (1 << 64) - 1


def plain_mix(x, seed):
    """Splitmix64's finisher over a value moved by a seed."""
    x = x + 0x9E3779B97F4A7C15 * (seed + 1) & _LOW
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _LOW
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _LOW
    return x ^ x >> 31


def plain_buckets(text):
    """Buckets of tokens and neighbouring tokens, a byte at a time: runs of letters and digits, and runs of other marks."""
    tokens, kind_before = [], None
    for b in (text or "").encode():
        kind = "space" if b in b" \t\n\x0b\x0c\r" else "word" if b >= 128 or chr(b).isalnum() else "mark"
        if kind != "space":
            if kind != kind_before:
                tokens.append([])
            tokens[-1].append(b)
        kind_before = kind
    hashes = [sum(plain_mix((k % 32) * 256 + b, 3) for k, b in enumerate(t)) & _LOW for t in tokens]
    return [plain_mix(h, 4) % 4096 for h in hashes] + [plain_mix((b - a) & _LOW, 5) % 4096 for a, b in itertools.pairwise(hashes)]


def plain_sample(rows, labels):
    """Importance resampling without the operator: models, weights, variates, the number to draw, and the draw."""
    buckets = [plain_buckets(t) for _, t in rows]
    known = [(d, q) for d, q in labels if d is not None and q is not None]
    good = {d for d, q in known if q == 1}
    raw, target = [0] * 4096, [0] * 4096
    for (d, _), own in zip(rows, buckets, strict=True):
        for b in own:
            raw[b] += 1
            target[b] += d in good
    if not known or not sum(target):
        return list(range(len(rows)))
    p = [(n + 1) / (sum(raw) + 4096) for n in raw]
    q = [(n + 64 * 4096 * x) / (sum(target) + 64 * 4096) for n, x in zip(target, p, strict=True)]
    weight = [sum(math.log(q[b]) - math.log(p[b]) for b in own) for own in buckets]
    share = sum(q == 1 for _, q in known) / len(known)
    k = round(sum(min(1, share * math.exp(min(w, 50))) for w in weight))
    uniform = [((plain_mix((-1 if d is None else d) ^ 20240, 9) >> 12) + 0.5) / 2**52 for d, _ in rows]
    key = [w - math.log(-math.log(u)) for w, u in zip(weight, uniform, strict=True)]
    last = sorted(key, reverse=True)[k - 1] if 0 < k <= len(rows) else math.inf if k <= 0 else -math.inf
    return [n for n, x in enumerate(key) if x >= last - 1e-12]


def test_quality_sample_equals_brute_force(spark, rows):
    draw = random.Random(10)
    good = "the of and ein der".split()
    texts = [(k, t) for k, t, *_ in rows] + [(1000 + k, " ".join(draw.choices(good, k=60))) for k in range(30)] + [(3, "x1 ## !!"), (None, "the of"), (None, "!! ##"), (None, None), (7, texts_of_7 := "the the of"), (7, texts_of_7)]
    labels = [(k, int(k >= 1000)) for k, _ in texts if k is not None and k % 2 == 0] + [(None, 1), (5, None), (1001, 2), (1001, 1)]
    frame = spark.createDataFrame([(*r, n, "c") for n, r in enumerate(texts)], "doc_id long, text string, `weight` int, `a.b` string").repartition(3)
    given = spark.createDataFrame(labels, "doc_id long, quality int")
    expected = plain_sample(texts, labels)
    assert 0 < len(expected) < len(texts)
    kept = quality.keep_target(frame, given)
    assert kept.columns == frame.columns and sorted(r["weight"] for r in kept.collect()) == expected
    found = quality.resample(frame, given).collect()
    assert sorted((r["doc_id"] or -1) for r in found) == sorted((texts[n][0] or -1) for n in expected)


ODD_COLUMNS = "doc_id long, text string, row int, Row_ string, `a.b` string, _tidewire_id int, fp string, id string, weight double, `x``y` int"


def odd_rows(spark, rows):
    return spark.createDataFrame([(d, t, 7, "r", "dot", 77, "f", "i", 0.5, 3) for d, t in rows], ODD_COLUMNS).repartition(3)


def test_stages_hand_on_odd_columns(spark):
    """Names with dots and quote marks, and names that helpers might have."""
    long_ = " ".join(f"w{k}" for k in range(90))
    frame = odd_rows(spark, [(1, "a b c"), (1, "a b c"), (1, "z"), (2, "A b c"), (None, "q"), (None, "q"), (None, None), (3, long_), (4, long_ + " more")])
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    for stage, kept in (
        (lambda d: quality.keep_target(d, labels), None),
        (radix_dedup.keep_largest, [(1, "z"), (2, "A b c"), (3, long_), (4, long_ + " more"), (None, None), (None, "q")]),
        (simhash.one_of_each_group, [(1, "a b c"), (1, "z"), (3, long_), (None, None), (None, "q")]),
    ):
        out = stage(frame)
        assert out.columns == frame.columns
        found = out.collect()
        assert all(tuple(r)[2:] == (7, "r", "dot", 77, "f", "i", 0.5, 3) for r in found)
        if kept is not None:
            assert sorted(((r["doc_id"], r["text"]) for r in found), key=str) == sorted(kept, key=str)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    kept = quality.resample(documents, labels.filter("doc_id % 2 = 0")).select("doc_id")
    held = labels.filter("doc_id % 2 = 1").join(kept.withColumn("in", F.lit(1)), "doc_id", "left")
    good, bad = (held.filter(f"quality = {q}").agg(F.avg(F.coalesce("in", F.lit(0)))).first()[0] for q in (1, 0))
    assert good > 0.98 and bad < 0.05


def test_quality_edges(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.resample(docs, labels).count() == docs.count()
    assert quality.resample(empty, labels).count() == 0
    kept = quality.keep_target(docs, labels)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    ties = spark.createDataFrame([(float(k % 2),) for k in range(50)], "key double")
    assert quality.top_k(ties, 10, few=2).count() == 25


# --- WARC


def test_warc_round_trip(spark):
    html = ["<p>one</p>", "<p>one</p>", "", None, "é" * 1000, "a\r\n\r\nWARC/1.1\r\nb", "<p>one</p>", "x"]
    pages = spark.createDataFrame([(k, f"http://h{k}.example/p?q={k} z", t, "clash", 1) for k, t in enumerate(html)] + [(None, None, "x", "clash", 1), (9, "http://[bad", "y", "c", 1), (9, "http://[bad", "y", "c", 1)], "page_id long, url string, html string, type string, size int")
    archives = warc.write_archives(pages.repartition(3))
    found = warc.assemble_written(warc.read_archives(archives)).collect()
    assert len(found) == 11
    rows = {}
    for r in found:
        page = r["metadata"]["fields"]["page_id"]
        rows.setdefault(int(page) if page else None, []).append(r)
    assert len(rows[9]) == 2 and all(r["response"]["type"] == "response" for r in rows[9])
    for k, t in [*enumerate(html), (None, "x")]:
        payload = (t or "").encode()
        (r,) = rows[k]
        same = [j for j, u in enumerate(html) if (u or "") == (t or "")]
        keeper = max(same)
        assert r["response"]["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r["metadata"]["fields"]["payload_bytes"] == str(len(payload))
        assert r["request"]["concurrent_to"] == [r["capture_id"]] and r["metadata"]["concurrent_to"] == [r["capture_id"]]
        assert r["response"]["type"] == ("response" if k == keeper else "revisit")
        if k == keeper:
            assert r["response"]["payload"] == payload
        else:
            assert r["response"]["refers_to"].split(":")[3] == str(keeper)


def test_warc_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(18)
    html = ["", None, "é", "a", "a", *(draw.choice(["p", "q", "<p>" + "y" * 3000]) for _ in range(40))]
    ids = draw.sample(range(-5, 200), len(html))
    rows = [(k, draw.choice([None, "", "http://h.example/a?b", "no address at all"]), t, "x") for k, t in zip(ids, html, strict=True)]
    spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    payloads = {k: (t or "").encode() for k, _, t, _ in rows}
    expected = []
    for k, data in payloads.items():
        first = max(j for j, other in payloads.items() if other == data)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((k, len(data), digest, "response" if k == first else "revisit", None if k == first else first))
    found = queries.op3_warc_transactions(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_warc_least_bytes_and_empty(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    kinds = {r["metadata"]["fields"]["page_id"]: r["response"]["type"] for r in warc.assemble_written(warc.read_archives(warc.write_archives(pages, 3))).collect()}
    assert kinds == {"1": "response", "2": "response", "3": "revisit", "4": "response"}
    assert warc.assemble_written(warc.read_archives(warc.write_archives(pages.limit(0)))).count() == 0


def test_warc_assembly_by_any_link(spark, tmp_path):
    make = lambda kind, id_, to=(), block=b"k: v\r\n": warc.record(kind, [("WARC-Record-ID", id_), *(("WARC-Concurrent-To", t) for t in to), ("Content-Type", "application/warc-fields")], block)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join([
        make("warcinfo", "<i>"), make("metadata", "<m1>", ["<q1>"]), make("request", "<q1>", ["<r1>"]), make("response", "<r1>"),
        make("response", "<r2>", ["<q2>"]), make("request", "<q2>"), make("metadata", "<m2>", ["<r2>"]), make("metadata", "<lost>", ["<nowhere>"]),
    ]))
    plain = tmp_path / "b.warc"
    plain.write_bytes(gzip.decompress(path.read_bytes()).replace(b"1>", b"7>").replace(b"2>", b"8>").replace(b"<lost>", b"<gone>"))
    archives = spark.createDataFrame([(str(path),), (str(plain),)], "path string")
    found = {r["capture_id"]: (r["request"] and r["request"]["record_id"], r["metadata"] and r["metadata"]["record_id"], r["response"] is None) for r in warc.assemble(warc.read_archives(archives)).collect()}
    assert found == {
        "<r1>": ("<q1>", "<m1>", False), "<r2>": ("<q2>", "<m2>", False), "<lost>": (None, "<lost>", True),
        "<r7>": ("<q7>", "<m7>", False), "<r8>": ("<q8>", "<m8>", False), "<gone>": (None, "<gone>", True),
    }


# --- SimHash


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=3):
    root = {k: k for k in fps}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= radius:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {k: top(k) for k in fps}


def test_simhash_equals_brute_force(spark, docs, rows):
    fps = {k: plain_fingerprint(t) for k, t, *_ in rows}
    expected = plain_components(fps)
    for r in simhash.simhash_components(docs).collect():
        assert r["fingerprint"] == f"{fps[r['doc_id']]:016x}" and r["component_id"] == expected[r["doc_id"]]


@pytest.mark.parametrize("tile", [4096, 16])
def test_simhash_links_lose_nothing(spark, tile):
    draw = random.Random(3)
    near = 0x0123456789ABCDEF
    values = {near}
    while len(values) < 150:  # one hot group, chains, and others
        x = draw.choice([near, draw.choice(sorted(values)), draw.getrandbits(64)])
        for _ in range(draw.randrange(5)):
            x ^= 1 << draw.randrange(64)
        values.add(x)
    fps = dict(enumerate(sorted(values)))
    frame = spark.createDataFrame([(k, bytearray(v.to_bytes(8, "big"))) for k, v in fps.items()], "doc_id long, fp binary")
    links = simhash.class_links(frame.select("fp"), simhash.block_keys(64, 3, 2), 1, 3, tile)
    roots = {int.from_bytes(r["node"], "big"): int.from_bytes(r["root"], "big") for r in simhash.components(links).collect()}
    expected = plain_components(fps)
    assert {v: roots.get(v, v) for v in fps.values()} == {fps[k]: fps[r] for k, r in expected.items()}


def test_bit_planes_count_distances():
    rows = np.random.default_rng(1).integers(0, 2**64, (200, 4), dtype=np.uint64)
    rows[100:150] = rows[:50] ^ (np.uint64(1) << np.random.default_rng(2).integers(0, 64, (50, 4)).astype(np.uint64))
    for d, radius in ((1, 3), (100, 3), (100, 4), (63, 128), (64, 130)):
        near = np.unpackbits(simhash.Planes(rows).within(d, radius, simhash._pack(np.arange(200) < 200 - d)).view(np.uint8), bitorder="little")[: 200 - d]
        assert (near == (np.bitwise_count(rows[:-d] ^ rows[d:]).sum(axis=1) <= radius)).all()


def test_near_copies_go(spark):
    draw = random.Random(4)
    texts = [" ".join(f"{draw.choice('abcdefgh')}{draw.randrange(500)}" for _ in range(300)) for _ in range(40)]
    copies = [t.replace(t.split()[100], "changed") + " more" for t in texts[:10]]
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts + copies)] + [(None, None, "x", 1)], "doc_id long, text string, fp string, root int")
    kept = simhash.one_of_each_group(frame)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {*range(40), None}


def plain_shingles(text):
    own = (text or "").lower().split()
    return {" ".join(own[k : k + 5]) for k in range(max(1, len(own) - 4))} if own else set()


def test_near_groups_equal_brute_force(spark):
    """Fields of texts with ever more words changed: only overlaps of 0.8 or more link, chains included."""
    draw, texts = random.Random(8), []
    for base in range(12):
        own = [f"w{draw.randrange(10**6)}" for _ in range(400)]
        texts.append(" ".join(own))
        for changed in (2, 4, 6, 10, 12, 14, 16):  # overlaps from 0.95 to 0.65
            other = list(own)
            for k in draw.sample(range(len(own)), changed):
                other[k] = f"x{draw.randrange(10**6)}"
            texts.append(" ".join(other))
    sets = [plain_shingles(t) for t in texts]
    root = list(range(len(texts)))
    overlap = lambda a, b: len(a & b) / len(a | b)
    while True:
        merged = [min(root[j] for j in range(len(texts)) if i == j or overlap(sets[i], sets[j]) >= 0.8) for i in range(len(texts))]
        if merged == root:
            break
        root = merged
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.one_of_each_group(frame).collect()} == {*root}
    assert 12 < len({*root}) < len(texts)


@pytest.mark.parametrize(("tile", "tile_bytes"), [(1024, 1 << 25), (8, 1 << 25), (1024, 2000)])
def test_exact_links_hold_at_any_tile(spark, tile, tile_bytes):
    own = [f"w{k}" for k in range(60)]
    texts = [" ".join([*own[:60 - k], *(f"x{k}{i}" for i in range(k))]) for k in range(0, 24, 2)]
    fps = [simhash._bytes(simhash.fingerprint(t, 5, 4)) for t in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members = spark.createDataFrame([(bytearray(f), bytearray(b"r"), k) for k, f in enumerate(fps)], "fp binary, root binary, row long")
    links = simhash.exact_links(frame.withColumnRenamed("doc_id", "row"), members, 5, 4, 256, 0.8, tile, tile_bytes)
    roots = {bytes(r["node"]): bytes(r["root"]) for r in simhash.components(links).collect()}
    sets = [plain_shingles(t) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                assert roots.get(fps[i], fps[i]) == roots.get(fps[j], fps[j])
    assert len({roots.get(f, f) for f in fps}) > 1


@pytest.mark.parametrize("tile", [1024, 6])
def test_long_chains_are_compared_by_their_keys(spark, monkeypatch, tile):
    """A chain of texts, each near to the next one alone, beside a dense group and pairs; tiles far smaller than the chain."""
    draw, texts = random.Random(19), []
    own = [f"w{draw.randrange(10**6)}" for _ in range(100)]
    for _ in range(150):  # every step moves eight words on
        texts.append(" ".join(own[:100]))
        own = [*own[8:], *(f"w{draw.randrange(10**6)}" for _ in range(8))]
    dense = [f"d{draw.randrange(10**6)}" for _ in range(200)]
    texts += [" ".join([*dense[:k], "x", *dense[k:]]) for k in range(0, 150, 10)]
    sets, root = [plain_shingles(t) for t in texts], list(range(len(texts)))
    linked = [[j for j in range(len(texts)) if i == j or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(texts))]
    while (merged := [min(root[j] for j in linked[i]) for i in range(len(texts))]) != root:
        root = merged
    used = []
    plain = simhash._buckets

    def small(members, entries, _):
        found = plain(members, entries, tile)
        used.append((members.count(), found.count()))
        return found

    monkeypatch.setattr(simhash, "_buckets", small)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.one_of_each_group(frame).collect()) == sorted(set(root))
    (members, rows), = used
    assert rows == members if tile == 1024 else rows > members


def test_overlap_reaches_its_bound():
    draw = np.random.default_rng(5)
    for _ in range(300):
        a, b = (np.unique(draw.integers(0, 40, draw.integers(0, 40)).astype(np.uint64)) for _ in "ab")
        both = len({*a.tolist()} | {*b.tolist()})
        assert simhash.overlap_reaches(a, b, 0.8) == (5 * len({*a.tolist()} & {*b.tolist()}) >= 4 * both)


@pytest.mark.parametrize("at_once", [1 << 22, 100])
def test_many_overlaps_equal_each_alone(monkeypatch, at_once):
    monkeypatch.setattr(simhash, "_MARKED", at_once)
    draw = np.random.default_rng(6)
    sets = [np.unique(draw.integers(0, 30, n).astype(np.uint64)) for n in (0, 0, 1, *draw.integers(10, 90, 57))]
    a, b = (x.ravel() for x in np.indices((60, 60)))
    alone = [simhash.overlap_reaches(sets[i], sets[j], 0.8) for i, j in zip(a, b, strict=True)]
    assert simhash.overlaps_reach(sets, a, b, 0.8).tolist() == alone and 60 < sum(alone) < 3600


@pytest.mark.parametrize("at_once", [1, 7, 1 << 12])
def test_several_lags_link_like_one(monkeypatch, at_once):
    monkeypatch.setattr(simhash, "_WORDS", at_once)
    draw = np.random.default_rng(7)
    rows = draw.integers(0, 2**64, (400, 1), dtype=np.uint64)
    for _ in range(300):  # chains
        i, j = draw.integers(0, 400, 2)
        rows[i] = rows[j] ^ (np.uint64(1) << draw.integers(0, 64, 1).astype(np.uint64))
    bucket = np.sort(draw.integers(0, 9, 400))
    near = (np.bitwise_count(rows ^ rows[:, 0]) <= 3) & (bucket[:, None] == bucket)
    root = np.arange(400)
    while (least := np.where(near, root, 400).min(axis=1)).tolist() != root.tolist():
        root = least
    assert dict(simhash.star_links(rows, bucket, 3)) == {i: r for i, r in enumerate(root.tolist()) if i != r}


def near_pairs(spark, pairs):
    """Ids that stay, of pairs of texts with the ids 2 k and 2 k + 1."""
    texts = [t for pair in pairs for t in pair]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(r["doc_id"] for r in simhash.one_of_each_group(frame).collect())


def test_no_near_copy_of_any_length_is_missed(spark):
    """Overlaps of 0.8 and little more, in short and in long texts."""
    draw, pairs = random.Random(11), []
    for k in range(390):
        n = 8 + k % 13 if k < 260 else draw.randrange(200, 500)
        own = [f"w{draw.randrange(10**6)}" for _ in range(n)]
        more = [f"x{draw.randrange(10**6)}" for _ in range((n - 4) // 4)]
        pairs.append((" ".join(own), " ".join(own + more)))
    assert near_pairs(spark, pairs) == [*range(0, 780, 2)]


def test_repeated_lines_hide_no_near_copy(spark):
    draw, pairs = random.Random(12), []
    for times in (5, 10, 20, 40) * 5:
        own = " ".join(f"w{draw.randrange(10**6)}" for _ in range(204))
        line = "\n" + " ".join(f"l{draw.randrange(10**6)}" for _ in range(11))
        pairs.append((own + line, own + line * times))
    assert near_pairs(spark, pairs) == [*range(0, 40, 2)]


def test_one_repeated_line_makes_no_near_copy(spark):
    """Texts that have a line repeated in common, and little else."""
    draw = random.Random(13)
    line = "\n" + " ".join(f"l{k}" for k in range(11))
    pairs = [[" ".join(f"w{draw.randrange(10**6)}" for _ in range(64)) + line * 70 for _ in "ab"] for _ in range(5)]
    a, b = map(plain_shingles, pairs[0])
    assert len(a & b) < 0.15 * len(a | b)
    assert near_pairs(spark, pairs) == [*range(10)]


def test_near_copies_under_repeated_and_missing_ids(spark):
    draw = random.Random(14)
    a, b, c, d, e = (" ".join(f"w{draw.randrange(10**6)}" for _ in range(100)) for _ in range(5))
    rows = [
        (1, a), (2, a + " more"), (2, b),  # the near copy goes, the other text of its id stays
        (3, c), (3, c + " more"),  # one of two under one id
        (None, d), (None, d + " more"), (None, d + " more"),  # one of several without an id
        (5, e + " more"), (5, e + " more"), (None, e), (6, e),  # one of several equal rows; those without an id go
    ]
    frame = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, digest string").repartition(3)
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.one_of_each_group(frame).collect()), key=str)
    least = lambda t: min((t, t + " more"), key=lambda x: (xxhash.xxh64_intdigest(x, 42) + 2**63) % 2**64)
    assert kept == sorted([(1, a), (2, b), (3, least(c)), (None, least(d)), (5, e + " more")], key=str)


def test_simhash_edges(spark, empty):
    assert simhash.simhash_components(empty).count() == 0
    assert simhash.one_of_each_group(empty).count() == 0
    found = simhash.simhash_components(repeated(spark)).collect()
    assert len(found) == 6 and {r["component_id"] for r in found if r["doc_id"] in (1, 2)} == {1}


# --- odd addresses


def test_no_address_is_turned_away():
    for url, line in (
        ("http://a\u2100b/x?y#z", "GET /x?y HTTP/1.1\r\nHost: a\u2100b"), ("http://[::1/x", "GET /x HTTP/1.1\r\nHost: [::1"), ("//\u2100", "GET / HTTP/1.1\r\nHost: \u2100"),
        ("?", "GET / HTTP/1.1\r\nHost: "), ("", "GET / HTTP/1.1\r\nHost: "), (None, "GET / HTTP/1.1\r\nHost: "), ("http://e\r\nx/", "GET / HTTP/1.1\r\nHost: ex"),
    ):
        packed, plain = warc.capture(1, url, b"", "D", None), b""
        while packed:
            one = zlib.decompressobj(31)
            plain, packed = plain + one.decompress(packed), one.unused_data
        assert f"\r\n\r\n{line}\r\n\r\n".encode() in plain


# --- licences


def test_licenses_equal_sql(spark, docs, rows):
    found = sorted(map(tuple, licenses.scan(docs).collect()))
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    assert found == sorted(con.execute(licenses.scan_sql()).fetchall()) and found


def plain_units(text):
    """Lines, and sentences cut by hand: at blank lines and colons at a line's end, and where a mark, white space and a capital follow each other."""
    yield from (("line", k, t) for k, t in enumerate((text or "").split("\n"), 1))
    k = 1
    for block in re.split(r"[\n:][ \t\r]*\n", text or ""):
        start = 0
        for m in re.finditer(r"""(?<=[.!?])[ \t\r\n#*/;-]+(?=[A-Z("'\[])""", block):
            yield "sentence", k, block[start : m.start()]
            start, k = m.end(), k + 1
        yield "sentence", k, block[start:]
        k += 1


def plain_scan(texts, threshold=0.8):
    for doc, text in texts:
        for unit, place, part in plain_units(text):
            own = {*licenses.bigrams_of(part)}
            scores = [(-2 * len(own & {*other}) / (len(own) + len(other)), name) for name, all_ in licenses.TEMPLATES.items() for s in all_ if (other := licenses.bigrams_of(s))]
            best = min(scores)
            if own and -best[0] >= threshold:
                yield doc, unit, place, best[1], -best[0]


MIT_TEXT = """MIT License

Copyright (c) 2024 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
GPL_COMMENT = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
import os
"""
LICENCE_TEXTS = [
    MIT_TEXT, GPL_COMMENT, "Copyright 2024 Foo Inc. Released under the MIT License. More prose here.", "Photo by Jane Doe. Licensed under CC BY-NC 4.0.",
    "// SPDX-License-Identifier: MIT\nint x;", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: Apache-2.0", "SPDX-License-Identifier: EPL-2.0",
    "This work is licensed under the GNU Affero\nGeneral Public License, version 3.", "under the MIT License Released", "released UNDER the mit, license!", "Released under MIT License.",
    "the Apache License, Version 2.0. Licensed under the", "Licensed under CC BY-NC 4.0", "nothing here at all", "", None, "a. B. C! D? (e) f:\n\n\n \n G", "Licensed under the Apache License,\r\nVersion 2.0.\x01 x",
]


def test_license_bounds_are_exact(spark):
    texts = list(enumerate(LICENCE_TEXTS))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = sorted(map(tuple, licenses.scan(frame).collect()))
    assert found == sorted(plain_scan([(k, t) for k, t in texts if k != len(texts) - 1])) + [r for r in found if r[0] == len(texts) - 1]
    names = {k: {r[3] for r in found if r[0] == k} for k, _ in texts}
    assert [names[k] for k in range(9)] == [{"MIT"}, {"GPL-3.0"}, {"MIT"}, {"CC-BY-NC-4.0"}, {"MIT"}, {"GPL-2.0"}, {"Apache-2.0"}, set(), {"AGPL-3.0"}]
    assert names[len(texts) - 1] == {"Apache-2.0"}
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    assert found == sorted(con.execute(licenses.scan_sql()).fetchall())


def test_license_scan_stays_in_the_jvm(spark, docs, empty):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licenses.scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in ("Python", "Arrow", "Pandas", "Exchange") if n in plan]
    assert licenses.scan(empty).count() == 0 and licenses.scan(repeated(spark)).count() == 0
    twice = spark.createDataFrame([(None, "Released under the MIT License.")] * 2, "doc_id long, text string")
    assert licenses.scan(twice).count() == 4


# --- byte-level BPE


def test_bpe_digests(spark, docs, rows, empty):
    library = Tokenizer.from_file(BYTE)
    for r in bpe.encode_documents(docs, RANKS, P.PATTERN).collect():
        text = rows[r["doc_id"]][1] or ""
        ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.encode_documents(empty, RANKS, P.PATTERN).count() == 0


def test_encoders_take_repeated_and_missing_ids(spark):
    frame = repeated(spark)
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    encoded = sorted(((r["doc_id"], r["decoded_sha256"]) for r in bpe.encode_documents(frame, RANKS, P.PATTERN).collect()), key=str)
    assert encoded == sorted(((d, hashlib.sha256(t.encode()).hexdigest()) for d, t in rows), key=str)
    packed = packing.pack(frame, BYTE, 8).collect()
    assert sorted(str(r["doc_id"]) for r in packed if r["piece"] == 0) == sorted(str(d) for d, _ in rows)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in packed)
    assert len({p[:2] for p in places}) == len(places) and all(a[1] + a[2] == b[1] for a, b in itertools.pairwise(places) if a[0] == b[0])


# --- piecewise hashing


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance():
    draw = random.Random(6)
    for _ in range(400):
        a, b = ("".join(draw.choices("abcd", k=draw.randrange(40))) for _ in range(2))
        assert ctph.edit_distance(a, b) == plain_distance(a, b)


def test_fingerprints_follow_content(monkeypatch):
    draw = random.Random(7)
    text = " ".join(f"w{draw.randrange(9999)}" for _ in range(3000))
    other = " ".join(f"v{draw.randrange(9999)}" for _ in range(3000))
    near = text[:5000] + "inserted" + text[5000:]
    own = ctph.fingerprint(text)
    assert ctph.likeness(own, ctph.fingerprint(near)) > 0.9 and ctph.likeness(own, ctph.fingerprint(other)) < 0.3 and ctph.likeness(own, own) == 1
    monkeypatch.setattr(ctph, "_PART", 211)
    assert ctph.fingerprint(text) == own
    assert ctph.likeness(ctph.fingerprint(""), ctph.fingerprint("")) == 1 and ctph.likeness(ctph.fingerprint(""), ctph.fingerprint("a")) == 0


def test_long_repetitive_texts_count_to_their_end():
    """More chunks than a text without repeats has; what differs at the end shows."""
    draw = random.Random(15)
    seen = 0
    for _ in range(20):
        line = " ".join(f"l{draw.randrange(999)}" for _ in range(5)) + "\n"
        text = line * 600
        end = "".join(f"e{draw.randrange(10**6)} " for _ in range(len(text) // 12))
        own, other = (ctph.fingerprint(t) for t in (text, text[: len(text) // 2] + end))
        if max(len(s) for s in own.split(":")[1:]) >= 192:
            seen += 1
            assert ctph.likeness(own, other) < 0.7
            assert ctph.likeness(own, ctph.fingerprint(text[: -len(line)] + line.upper())) < 1
    assert seen > 5


def plain_window_hash(data, at):
    """Of the seven bytes that end at a place, fewer at the start."""
    h = sum((data[at - k] + 1) * pow(0x01000193, k, 1 << 32) for k in range(min(7, at + 1))) & 0xFFFFFFFF
    h ^= h >> 15
    h = h * 0x85EBCA6B & 0xFFFFFFFF
    return h ^ h >> 13


def plain_piecewise(text):
    """The fingerprint byte by byte: a letter for each chunk, of the sum of its window hashes."""
    data = (text or "").encode()
    hashes = [plain_window_hash(data, k) for k in range(len(data))]

    def letters(block):
        out, total = "", 0
        for h in hashes:
            total += h
            if h % block == block - 1:
                out, total = out + ctph._LETTERS[(total * 0x9E3779B97F4A7C15 & _LOW) >> 58], 0
        return out + (ctph._LETTERS[(total * 0x9E3779B97F4A7C15 & _LOW) >> 58] if total else "")

    block = 4
    while block * 64 < len(data):
        block *= 2
    while block > 4 and len(letters(block)) < 32:
        block //= 2
    return f"{block}:{letters(block)}:{letters(2 * block)}"


def plain_likeness(a, b):
    if a == b:
        return 1.0
    (x, *own), (y, *other) = a.split(":"), b.split(":")
    best = 0.0
    for i, s in enumerate(own):
        for j, t in enumerate(other):
            if int(x) << i == int(y) << j and (s or t):
                best = max(best, 1 - plain_distance(s, t) / max(len(s), len(t)))
    return best


def test_fingerprints_equal_brute_force(rows):
    draw = random.Random(16)
    texts = [t or "" for _, t, *_ in rows if len(t or "") < 4000] + ["".join(draw.choices("aé \nb", k=n)) for n in (1, 3, 6, 7, 8, 255, 256, 257, 700)] + ["same line\n" * 90]
    own = [plain_piecewise(t) for t in texts]
    assert [ctph.fingerprint(t) for t in texts] == own
    for a, b in draw.sample(list(itertools.combinations(own, 2)), 150):
        assert ctph.likeness(a, b) == plain_likeness(a, b)


def test_piecewise_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(17)
    words = [f"w{k}" for k in range(30)]
    texts = [None, "", "é", "ab", "x" * 700, *(" ".join(draw.choices(words, k=n)) for n in (1, 5, 40, 40, 90))] * 2
    order = draw.sample(range(100), len(texts))
    spark.createDataFrame(list(zip(order, texts, strict=True)), "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    by_id = {k: t or "" for k, t in zip(order, texts, strict=True)}
    ids = sorted(by_id, reverse=True)
    found = {r["doc_id"]: r for r in queries.op7_piecewise_fingerprints(spark, str(tmp_path)).collect()}
    assert sorted(found, reverse=True) == ids
    for k, key in enumerate(ids):
        text, following = by_id[key], by_id[ids[(k + 1) % len(ids)]]
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        own, other, next_ = plain_piecewise(text), plain_piecewise(changed), plain_piecewise(following)
        r = found[key]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest(), own, other)
        assert (r["near_edited"], r["near_next"]) == (plain_likeness(own, other), plain_likeness(own, next_))


def test_neighbours(spark, docs, rows, empty):
    texts = [t or "" for _, t, *_ in rows]
    found = {r["doc_id"]: r for r in ctph.neighbours(docs).collect()}
    assert len(found) == len(rows)
    for k, text in enumerate(texts):
        following = texts[k - 1]
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        r, own = found[k], ctph.fingerprint(text)
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest(), own, ctph.fingerprint(changed))
        assert (r["near_edited"], r["near_next"]) == (ctph.likeness(own, ctph.fingerprint(changed)), ctph.likeness(own, ctph.fingerprint(following)))
    assert ctph.neighbours(empty).count() == 0
    assert ctph.neighbours(docs.limit(1)).first()["near_next"] == 1
    assert ctph.neighbours(repeated(spark)).count() == 6


# --- token store


def test_token_store(spark, docs, rows, empty):
    library = Tokenizer.from_file(WORD)
    manifest = token_store.write_store(docs, WORD, 1, 16)
    found, start = {r["doc_id"]: r for r in token_store.read_store(manifest, with_ids=True).collect()}, 0
    for k, text, *_ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert (found[k]["start"], found[k]["n_tokens"], found[k]["ids_crc32"], bytes(found[k]["ids"])) == (start, len(ids) // 4, zlib.crc32(ids), ids)
        start += len(ids) // 4
    asked = spark.createDataFrame([(3,), (10,), (10,), (10_000,), (None,)], "doc_id long")
    got = token_store.lookup(manifest, asked).collect()
    assert sorted(r["doc_id"] for r in got) == [3, 10, 10]
    assert all(np.frombuffer(r["ids"], "<u2").astype("<u4").tobytes() == bytes(found[r["doc_id"]]["ids"]) for r in got)
    nothing = token_store.write_store(empty, WORD, 1)
    assert token_store.read_store(nothing).count() == 0 and token_store.lookup(nothing, asked).count() == 0


def test_token_store_repeated_keys(spark):
    manifest = token_store.write_store(repeated(spark), WORD, 1)
    rows = token_store.read_store(manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, None, None, 1, 1, 2]
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1]]
    assert token_store.lookup(manifest, spark.createDataFrame([(1,)], "doc_id long")).count() == 2


def test_lookup_finds_keys_over_shards(spark):
    """Keys that fill several shards, gaps, keys outside of all shards, and many ranges."""
    draw = random.Random(21)
    keys = [5] * 40 + [draw.randrange(400) * 3 for _ in range(200)] + [None]
    frame = spark.createDataFrame([(k, f"w{n}") for n, k in enumerate(keys)], "doc_id long, text string")
    manifest = token_store.write_store(frame, WORD, 1, 12)
    shards = manifest.collect()
    assert len(shards) > 8 and sum(s["first_key"] == s["last_key"] == 5 for s in shards) > 0
    asked = [5, 5, -1, 10**6, 4, *range(0, 1300, 7)]
    got = sorted(r["doc_id"] for r in token_store.lookup(manifest, spark.createDataFrame([(k,) for k in asked], "doc_id long")).collect())
    assert got == sorted(k for k in asked for other in keys if k == other)
    plan = token_store._routed(manifest, spark.createDataFrame([(1,)], "doc_id long"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_files_are_read_by_as_many_tasks(spark):
    """The few bytes of a manifest don't end in one task."""
    frame = spark.createDataFrame([(k, f"text {k}") for k in range(400)], "doc_id long, text string")
    manifest = token_store.write_store(frame, WORD, 1, 50)
    used = token_store.read_store(manifest).select(F.spark_partition_id().alias("p")).distinct().count()
    assert used == manifest.count() == 8
    pages = frame.select(F.col("doc_id").alias("page_id"), F.lit("http://h/").alias("url"), F.col("text").alias("html")).repartition(6)
    archives = warc.write_archives(pages)
    n = archives.count()
    assert n > 1 and warc.read_archives(archives).select(F.spark_partition_id().alias("p")).distinct().count() == n


# --- exact copies


def test_equal_texts(spark, docs, rows, monkeypatch, empty):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for k, t, *_ in rows:
        groups.setdefault(lower(t), []).append(k)
    for first, growth in ((64, 16), (1, 3)):
        monkeypatch.setattr(radix_dedup, "FIRST", first)
        monkeypatch.setattr(radix_dedup, "GROWTH", growth)
        found = radix_dedup.equal_texts(docs).collect()
        assert len(found) == len(rows)
        for r in found:
            text = lower(rows[r["doc_id"]][1])
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(groups[text]), len(groups[text]), r["doc_id"] == max(groups[text]), hashlib.sha256(text.encode()).hexdigest())
    monkeypatch.setattr(radix_dedup, "FIRST", 64)
    kept = radix_dedup.keep_largest(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(map(max, groups.values()))
    assert radix_dedup.equal_texts(empty).count() == 0 and radix_dedup.keep_largest(empty).count() == 0
    assert sorted((r["doc_id"] or 0, r["text"]) for r in radix_dedup.keep_largest(repeated(spark)).collect()) == [(0, "Z"), (0, "q"), (2, "A b c d e f")]


# --- lengths


def test_length_histogram(spark, docs, rows, empty):
    library = Tokenizer.from_file(BYTE)
    sizes = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in rows]
    sums = length_histogram.length_histogram(docs, BYTE).cache()
    found = {r["length"]: r for r in sums.collect()}
    assert sorted(found) == sorted(set(sizes))
    for n, r in found.items():
        longer = [s for s in sizes if s >= n]
        assert (r["documents"], r["documents_from"], r["tokens_from"], r["all_tokens"], r["all_documents"]) == (sizes.count(n), len(longer), sum(longer), sum(sizes), len(sizes))
        assert r["tokens_cut_at_length"] == sum(min(s, n) for s in sizes)
        assert r["share_up_to"] == pytest.approx(sum(s <= n for s in sizes) / len(sizes))
    for limit in (1, 50, 5000, 10**9):
        assert length_histogram.cut_total(sums, limit).first()[0] == sum(min(s, limit) for s in sizes)
    assert length_histogram.quantile(sums, 0.5).first()[0] == sorted(sizes)[-(-len(sizes) // 2) - 1]
    assert length_histogram.length_histogram(empty, BYTE).count() == 0 and packing.pack(empty, BYTE).count() == 0


# --- queries and pipeline


def test_queries_are_named():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, 11)]
    assert set(queries.SQL) <= set(queries.QUERIES)


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Every stage of a small corpus against plain Python: the sample, one of equal texts, one of near copies, whole packing."""
    import corpus_pipeline

    draw, rows = random.Random(30), []
    good, bad = ([f"{c}{k}" for k in range(400)] for c in "gb")
    for k in range(60):
        rows.append(" ".join(draw.choices(good if k % 3 else bad, k=draw.choice([3, 30, 300]))))
    for text in rows[:20]:
        rows += [text, text.upper(), text.replace(" ", " and more ", 1), text + " tail"]
    rows += [None, "", " ", "x" * 5000]
    ids = draw.sample(range(1000), len(rows))
    docs = list(zip(ids, rows, strict=True))
    labels = [(d, int("g" in (t or "").lower()[:1]), 0) for d, t in docs[:50]]
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = [docs[n] for n in plain_sample(docs, [x[:2] for x in labels])]
    assert len(kept) < len(docs)
    groups = {}
    for d, t in kept:
        groups.setdefault((t or "").lower(), []).append((d, t))
    kept = sorted(max(g) if len(g) > 1 else g[0] for g in groups.values())
    sets, root = [plain_shingles(t) for _, t in kept], list(range(len(kept)))
    linked = [[j for j in range(len(kept)) if i == j or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(kept))]
    while (merged := [min(root[j] for j in linked[i]) for i in range(len(kept))]) != root:
        root = merged
    kept = [kept[k] for k in sorted(set(root))]
    library = Tokenizer.from_file(BYTE)
    sizes = {d: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in kept}
    found = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["length"]
    assert found == sizes


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == documents.columns
    texts = [r["text"].lower() for r in docs.collect()]
    assert len(texts) == len(set(texts)) <= documents.count()
    packed = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}


def test_a_worker_gives_memory_back_at_the_end(monkeypatch):
    from types import SimpleNamespace

    from tidewire.llm import shared

    trimmed = []
    monkeypatch.setattr(shared, "ctypes", SimpleNamespace(CDLL=lambda _: SimpleNamespace(malloc_trim=trimmed.append)))
    batches = [1, 2, 3]
    assert list(shared.released(lambda own: (2 * b for b in own))(iter(batches))) == [2, 4, 6] and trimmed == [0]
