"""Records, transactions, changelogs, envelopes and the binary form, each against a plain model or a fixed text."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions import binary, envelopes, lsn, naming, records
from tidewire.functions import types as kinds
from tidewire.operators import changelog as cl
from tidewire.operators import transactions as tx
from tidewire.plans import snapshots
from tidewire.streaming.log_source import Reassembly

COLUMN = records.COLUMN


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


# --- positions, names, types


def test_positions(spark):
    values = [("0/16B3748", 23803720), ("FFFFFFFF/FFFFFFFF", 2**64 - 1), ("1/0", 2**32), ("", None), (None, None), ("x/1", None), ("1", None)]
    frame = spark.createDataFrame([(a,) for a, _ in values], "a string")
    assert [None if r[0] is None else int(r[0]) for r in frame.select(lsn.lsn_number(F.col("a"))).collect()] == [b for _, b in values]
    newer = lambda a, b: one(spark, lsn.lsn_newer(F.lit(a).cast("string"), F.lit(b).cast("string")))[0]
    assert newer("80000000/0", "7FFFFFFF/FFFFFFFF") and not newer("0/1", "0/1") and not newer(None, "0/1") and not newer("0/1", "zz")
    assert one(spark, lsn.lsn_text(F.lit(23803720)))[0] == "0/16B3748"
    csn = lambda t: one(spark, lsn.parse_csn(F.lit(t)))[0]
    assert [csn(t) for t in ("100", "0x10", "ff", "zz")] == [100, 16, 255, None]


def test_positions_with_halves_beyond_32_bits(spark):
    """A half of more than eight digits counts in full."""
    values = [("40000000/11B1B42CF", (0x40000000 << 32) + 0x11B1B42CF), ("0/FFFFFFFFFFFFFFFF", 2**64 - 1), ("123456789/0", 0x123456789 << 32), ("0/10000000000000000", None)]
    frame = spark.createDataFrame([(a,) for a, _ in values], "a string")
    assert [None if r[0] is None else int(r[0]) for r in frame.select(lsn.lsn_number(F.col("a"))).collect()] == [b for _, b in values]


def test_newer_positions_with_halves_beyond_32_bits(spark):
    newer = lambda a, b: one(spark, lsn.lsn_newer(F.lit(a), F.lit(b)))[0]
    assert newer("C0000000/11B1B42CF", "C0000000/10000") and newer("0/100000000", "0/FFFFFFFF") and not newer("0/FFFFFFFF", "0/100000000")


def test_names():
    assert str(naming.TablePath.parse("t")) == "public.t" and str(naming.TablePath.parse("s.t")) == "s.t"
    for bad in ("a.b.c", ".t", "s.", ""):
        with pytest.raises(ValueError):
            naming.TablePath.parse(bad)
    with pytest.raises(ValueError):
        naming.quote(None)
    assert naming.quote_mark(" m ", "'") == "`" and naming.quote_mark("PG", " ") == '"'
    match = lambda s, t, w: naming.table_matches_text(s, t, "Public", w)
    assert match("public", "Orders", "orders") and match("PUBLIC", "orders_1", r"orders_\d+") and not match("public", "my_orders_1", r"orders_\d+")
    assert not match("public", "t{1}x", "t{1}") and not match(None, "t", "t")


def test_types(spark):
    assert kinds.map_type("numeric", 10, 5) == T.DecimalType(10, 5) and kinds.map_type("numeric") == T.DecimalType(38, 18)
    assert kinds.map_type("_float8") == T.ArrayType(T.DoubleType())
    for bad in ("json", "uuid", "interval", "_serial", "money"):
        with pytest.raises(kinds.UnsupportedTypeError):
            kinds.map_type(bad)
    with pytest.raises(kinds.UnsupportedTypeError):
        kinds.map_type("numeric", 39, 0)
    with pytest.raises(kinds.UnsupportedTypeError):
        kinds.check_dialect_type(T.TimestampNTZType(), 9)
    cast = lambda v, oid: one(spark, kinds.cast_by_oid(F.lit(v), oid))[0]
    assert cast("t", 16) is True and cast("f", 16) is False and cast("12", 23) == 12 and cast("1x", 23) is None and cast("x", 25) == "x"
    assert str(cast("2024-01-15 10:30:00.123456789", 1114)) == "2024-01-15 10:30:00.123456" and str(cast("2024-01-15 10:30:00", 1114)) == "2024-01-15 10:30:00"
    assert str(cast("2024-02-29", 1082)) == "2024-02-29"


# --- records

INSERT = records.json_record("public.t", "INSERT", [("id", "bigint", "1"), ("name", "character varying", "it's, [a] {b} \"c\""), ("note", "text", None)])
DELETE = records.json_record("s.x.t", "DELETE", [], [("id", "bigint", "1")])


def parse(spark, *data):
    log = spark.createDataFrame([("main", k, f"0/{k}", 1, d) for k, d in enumerate(data)], "slot string, pos long, lsn string, xid long, data string")
    return records.parse_records(log).orderBy("pos").collect()


def test_records(spark):
    rows = parse(spark, "BEGIN 100", "COMMIT 100 (at 2025-03-02 04:05:06.7+00) CSN 4711", "COMMIT 100 CSN zz", INSERT, DELETE, "INSERT: public.goods [id[integer]:1]", "noise", "{broken", None, "", '{"a": 1}')
    assert [r["type"] for r in rows] == ["BEGIN", "COMMIT", "COMMIT", "INSERT", "DELETE", "INSERT", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    assert [rows[1]["csn"], rows[2]["csn"]] == [4711, 0]
    assert (rows[3]["schema"], rows[3]["table"], rows[3]["before"]) == ("public", "t", None)
    assert [tuple(c) for c in rows[3]["after"]] == [("id", 20, "1"), ("name", 1043, "it's, [a] {b} \"c\""), ("note", 25, None)]
    assert (rows[4]["schema"], rows[4]["table"], rows[4]["after"]) == ("s.x", "t", None) and [tuple(c) for c in rows[4]["before"]] == [("id", 20, "1")]
    assert (rows[5]["schema"], rows[5]["table"], rows[5]["after"]) == ("public", "goods", None)


def test_ragged_records(spark):
    text = json.dumps({"table_name": "t", "op_type": "update", "columns_name": ["a", "b"], "columns_type": ["integer"], "columns_val": ["'null'"]})
    (row,) = parse(spark, text)
    assert row["type"] == "UPDATE" and row["schema"] is None and [tuple(c) for c in row["after"]] == [("a", 23, "null"), ("b", 25, None)]


def test_split_objects():
    assert list(records.split_objects('[{"a": "}{"}, {"b": {"c": "\\"}"}}] {"open": {')) == ['{"a": "}{"}', '{"b": {"c": "\\"}"}}']
    assert list(records.split_objects("")) == [] and list(records.split_objects("} {")) == []


# --- binary


def random_changes(draw):
    values = lambda: [(f"c{k}", draw.choice([20, 25, 1043]), draw.choice([None, "", "ä'\n", "x" * 300])) for k in range(draw.randrange(4))]
    out = []
    for _ in range(draw.randrange(1, 12)):
        kind = draw.choice(["BEGIN", "COMMIT", "INSERT", "UPDATE", "DELETE"])
        c = binary.WalChange(kind, draw.getrandbits(63))
        if kind == "BEGIN":
            c.csn = draw.getrandbits(40)
        elif kind == "COMMIT":
            c.xid = draw.getrandbits(40)
        else:
            c.schema, c.table = "public", "tä"
            c.after = None if kind == "DELETE" else values()
            c.before = values() if kind == "DELETE" or kind == "UPDATE" and draw.random() < 0.5 else None
        out.append(c)
    return out


@pytest.mark.parametrize("inside", [False, True])
def test_binary_round_trip(inside):
    draw = random.Random(1)
    for _ in range(300):
        changes = random_changes(draw)
        assert binary.decode_batch(binary.encode_batch(changes, inside)) == changes


def test_binary_faults():
    good = binary.WalChange("INSERT", 5, schema="s", table="t", after=[("a", 25, "b")])
    data = binary.encode_batch([good, good])
    broken = bytearray(data)
    broken[13] = 0xFF  # the length of the first schema name
    found = binary.decode_batch(bytes(broken))
    assert found[0].type == "UNKNOWN" and found[0].error and found[1] == good
    assert binary.decode_batch(b"") == [] and binary.decode_batch(b"\0\0\0\0rest") == []
    assert binary.decode_batch(data[:20])[-1].type == "UNKNOWN"
    assert binary.WalChange("BEGIN", (1 << 32) + 255).lsn == "1/FF"


def test_transactions_over_binary_batches(spark):
    """Transactions that begin, go on and end in different batches, at any place of the log."""
    draw, changes, expected, at = random.Random(5), [], [], 2**63 + 5
    for _ in range(40):
        begin, csn = at, draw.randrange(1, 99)
        changes.append(binary.WalChange("BEGIN", at, csn=csn))
        for _ in range(draw.randrange(5)):
            at += 1
            changes.append(binary.WalChange("INSERT", at, schema="s", table="t", after=[("a", 20, str(at))]))
            expected.append((at, csn, begin))
        at += 1
        changes.append(binary.WalChange("COMMIT", at, xid=1))
        at += 1
    batches = []
    while changes:
        n = draw.choice([1, 1, 2, 3, 9])
        batches.append(("main", 10**13 + len(batches), bytearray(binary.encode_batch(changes[:n]))))
        changes = changes[n:]
    log = spark.createDataFrame(batches, "slot string, pos long, data binary").repartition(4)
    found = tx.committed_prefix(binary.number_transactions(binary.decode_binary(log)))
    rows = found.select(envelopes.value_of(F.col("after"), "a").alias("a"), "commit_csn", "xid").collect()
    assert sorted((int(r[0]), r[1], r[2] % 2**64) for r in rows) == expected


def test_large_batches_keep_their_order(spark):
    text = "".join(json.dumps({"op_type": "INSERT", "n": k}) for k in range(1500))
    log = spark.createDataFrame([("main", 1, text), ("main", 2, text), ("main", 3, "BEGIN 1"), ("main", 4, None)], "slot string, pos long, data string")
    rows = records.split_batches(log)
    assert rows.count() == rows.select("pos", "k").distinct().count() == 3002


# --- transactions


def log_frame(spark, log):
    rows = [("main", pos, f"0/{pos:X}", xid, csn, kind, str(pos)) for pos, kind, xid, csn in log]
    return spark.createDataFrame(rows, "slot string, pos long, lsn string, xid long, csn long, type string, raw string")


def random_log(draw, n=60):
    log, pos = [], 0
    for _ in range(n):
        pos += draw.randrange(1, 4)
        kind = draw.choices(["BEGIN", "COMMIT", "INSERT", "DELETE", "UNKNOWN"], [3, 4, 8, 2, 1])[0]
        log.append((pos, kind, draw.randrange(6), draw.randrange(1, 50) if kind == "COMMIT" else 0))
    return log


@pytest.mark.parametrize("seed", range(4))
def test_committed_prefix_equals_the_rules(spark, seed):
    draw = random.Random(seed)
    for snapshot, last in ((-1, None), (20, None), (-1, "0/20"), (10, "0/10")):
        log = random_log(draw)
        model = Reassembly(snapshot, last)
        expected = []
        for pos, kind, xid, csn in log:
            expected += [(t, p) for t, p, *_ in model.add(pos, f"0/{pos:X}", xid, csn, kind, str(pos))]
        found = tx.committed_prefix(log_frame(spark, log), snapshot, last).orderBy("txn", "pos").select("txn", "pos").collect()
        assert [tuple(r) for r in found] == expected
        done = tx.watermark(log_frame(spark, log), last).first()
        assert (done["lsn"] if done else last) == model.last_lsn


def test_windows_go_over_markers_alone(spark):
    plan = tx.committed_prefix(log_frame(spark, random_log(random.Random(1))))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_interleaved_transactions():
    work, out = Reassembly(), []
    for pos, kind, xid in ((1, "BEGIN", 7), (2, "DELETE", 7), (3, "BEGIN", 8), (4, "INSERT", 8), (5, "COMMIT", 8), (6, "COMMIT", 7)):
        out.append([r[1] for r in work.add(pos, f"0/{pos * 8:X}", xid, 0, kind, "")])
    assert out == [[], [], [], [], [], [2, 4]] and work.last_lsn == "0/30"


def test_replay_is_by_commit(spark):
    log = [(0x11, "BEGIN", 1, 0), (0x12, "INSERT", 1, 0), (0x20, "COMMIT", 1, 0)]
    assert tx.committed_prefix(log_frame(spark, log), last_lsn="0/15").count() == 1
    assert tx.committed_prefix(log_frame(spark, log), last_lsn="0/20").count() == 0
    assert tx.watermark(log_frame(spark, log)).first()["lsn"] == "0/20" and tx.watermark(log_frame(spark, log), "0/99").first()["lsn"] == "0/99"


# --- changelogs


def test_applying_the_difference_gives_the_table(spark):
    draw = random.Random(2)
    state = lambda: [(k, draw.choice(["a", "b", None]), draw.randrange(2)) for k in range(30) if draw.random() < 0.7]
    a, b = (spark.createDataFrame(state(), "id long, v string, n int") for _ in range(2))
    diff = cl.diff_snapshots(a, b, ["id"])
    changes = diff.select("_op", "id", "after.v", "after.n", F.lit(1).alias("_pos"))
    assert sorted(map(tuple, cl.apply_changes(a, changes, ["id"], ["_pos"]).collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert cl.diff_snapshots(b, b, ["id"]).count() == 0


def test_poll_pages_break_ties(spark):
    rows = spark.createDataFrame([("A", "2024-01-01 00:00:00"), ("B", "2024-01-01 00:00:00"), ("C", "2024-01-01 00:00:00"), ("N", None)], "code string, t string").select("code", F.col("t").cast("timestamp_ntz").alias("updated_at"))
    cursor, sizes = cl.Cursor(), []
    for _ in range(3):
        page = cl.update_page(rows, "code", "updated_at", cursor, 2)
        sizes.append(page.count())
        cursor = cl.next_cursor(rows, "code", cursor, 2, "updated_at")
    assert sizes == [2, 1, 0] and cursor.last_update_key == "C"
    with pytest.raises(ValueError):
        cl.poll_cycle(rows, rows, "code", cursor, 0)
    with pytest.raises(ValueError):
        cl.initial_cursor(spark.createDataFrame([(None,)], "code string"), "code")


def test_poll_cycles_reach_the_table(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], "id long, v string, at long").withColumn("updated_at", F.timestamp_seconds("at").cast("timestamp_ntz")).drop("at")
    new = spark.createDataFrame([(1, "a", 1), (2, "B", 9), (4, "d", 9)], "id long, v string, at long").withColumn("updated_at", F.timestamp_seconds("at").cast("timestamp_ntz")).drop("at")
    cursor = cl.initial_cursor(old, "id", "updated_at")
    found = cl.poll_cycle(old, new, "id", cursor, 10, "updated_at").orderBy("_phase", "id").collect()
    assert [(r["_phase"], r["_op"], r["id"]) for r in found] == [(1, "u", 2), (1, "c", 4), (3, "d", 3)]
    assert found[0]["before"]["v"] == "b" and found[2]["after"] is None


def test_typed_rows(spark):
    image = "array<" + COLUMN + ">"
    rows = spark.createDataFrame([("INSERT", None, [("id", 20, "1"), ("d", 1082, "2024-01-01")]), ("UPDATE", None, [("id", 20, "x")]), ("DELETE", [("id", 20, "3")], None), ("INSERT", None, [])], f"type string, before {image}, after {image}")
    schema = T.StructType().add("id", "long").add("d", "date")
    assert [(r["_op"], r["id"], r["_error"]) for r in cl.typed_rows(rows, schema).collect()] == [("c", 1, []), ("u", None, ["id"]), ("d", 3, [])]
    assert cl.typed_rows(rows, schema, "drop").count() == 2
    with pytest.raises(Exception, match="no value of its type"):
        cl.typed_rows(rows, schema, "failfast").collect()


def test_upsert_and_delete(spark):
    stored = spark.createDataFrame([(1, "Alice", 20), (2, "Bob", None)], "id int, name string, age int")
    new = spark.createDataFrame([(1, "Alice", None), (3, "Cy", 3)], "id int, name string, age int")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(cl.upsert(stored, new, ["id"], ignore_null=True)) == [(1, "Alice", 20), (2, "Bob", None), (3, "Cy", 3)]
    assert rows(cl.upsert(stored, new, ["id"])) == [(1, "Alice", None), (2, "Bob", None), (3, "Cy", 3)]
    assert rows(cl.delete_by_key(stored, new, ["id"])) == [(2, "Bob", None)]


# --- envelopes and snapshots


def test_envelopes_are_json(spark):
    image = spark.createDataFrame([([("id", 20, "1"), ("s", 25, 'q"\\\n\x01é'), ("n", 25, None)],)], f"i array<{COLUMN}>")
    none = F.lit(None).cast(f"array<{COLUMN}>")
    ms = F.lit(5).cast("long")
    value = {"id": "1", "s": 'q"\\\n\x01é', "n": None}
    get = lambda c: json.loads(image.select(c).first()[0])
    d = get(envelopes.debezium(F.lit("c"), none, F.col("i"), "db", "s", "t", ms, F.lit("0/1")))
    assert list(d) == ["before", "after", "source", "op", "ts_ms", "transaction"] and d["after"] == value and d["before"] is None and d["source"]["lsn"] == "0/1"
    assert get(envelopes.debezium(F.lit("d"), F.col("i"), none, "db", "s", "t", ms, empty_object=True))["after"] == {}
    c = get(envelopes.canal(F.lit("d"), F.col("i"), none, "db", "t", ["id"], ms))
    assert c["data"] is None and c["old"] == value and c["type"] == "DELETE" and c["pkNames"] == ["id"]
    h = get(envelopes.he(F.lit("u"), none, F.col("i"), "db", "t", ["id"], ms))
    assert h["pkValues"] == ["1"] and h["old"] is None and "lsn" not in h
    assert image.select(envelopes.json_escape(F.lit('"\\\n\r\t\x01/é'))).first()[0] == '\\"\\\\\\n\\r\\t\\u0001/é'


def test_ranges():
    assert snapshots.split_ranges(1, 10, 3) == [(1, 3), (4, 6), (7, 10)] and snapshots.split_ranges(None, None, 3) == [(0, -1)]
    assert snapshots.split_ranges(1, 2, 4)[-1] == (1, 2)
    assert snapshots.chunk_ranges(1, 10, 4) == [(1, 4), (5, 8), (9, 10)] and snapshots.chunk_ranges(None, None, 4) == []
    for least, most, n in ((0, 99, 7), (-5, 5, 3), (0, 2**62, 8)):
        ranges = snapshots.split_ranges(least, most, n)
        assert ranges[0][0] == least and ranges[-1][1] == most and all(b + 1 == c for (_, b), (c, _) in zip(ranges, ranges[1:], strict=False))
    with pytest.raises(ValueError):
        snapshots.single_key(["a", "b"])
    with pytest.raises(ValueError):
        snapshots.single_key([])
