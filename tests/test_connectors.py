"""Dialect text, options, the catalog, transports, the streaming source, and JDBC round trips on an embedded database."""

import json

import pytest
from pyspark.sql import types as T

from tidewire.functions import dialect as d
from tidewire.functions.options import CatalogOptions, CdcOptions, JdbcOptions, OptionError
from tidewire.sources import catalog, jdbc, transport
from tidewire.streaming import capture
from tidewire.streaming.log_source import LogSource, reassemble_stream

# --- SQL text


def test_statements():
    x = d.POSTGRES_FAMILY
    assert x.insert("t", ["a", "b"]) == "INSERT INTO t(a, b) VALUES (:a, :b)"
    assert x.update("t", ["a", "b"], ["a"]) == "UPDATE t SET b = :b WHERE a = :a"
    assert x.delete("t", ["a", "b"], "?") == "DELETE FROM t WHERE a = ? AND b = ?"
    assert x.row_exists("t", ["a"]) == "SELECT 1 FROM t WHERE a = :a"
    assert x.upsert("t", ["a", "b"], ["a"], ignore_null=True).endswith("b=COALESCE(VALUES(b), b)")
    assert d.Dialect(mark='"').quote_identifier('a"b') == '"a""b"'
    assert x.keyset_page("t", ["a"], ["ts", "a"], 5) == "SELECT a FROM t WHERE ts > ? OR (ts = ? AND a > ?) ORDER BY ts, a LIMIT 5"
    assert x.keyset_page("t", ["a"], ["a"], 5, first=True) == "SELECT a FROM t ORDER BY a LIMIT 5"


def test_addresses():
    own = d.Dialect(name="own", prefix="jdbc:own:", drivers=("own.Driver", "other.Driver"), sibling_prefix="jdbc:postgresql:")
    assert own.accepts_url("jdbc:own://h/db") and not own.accepts_url("jdbc:postgresql://h/db") and own.accepts_url("jdbc:postgresql://h/db", lambda _: True) and not own.accepts_url(None)
    assert own.default_driver(lambda c: c == "other.Driver") == "other.Driver" and own.default_driver(lambda _: False) == "own.Driver"
    assert own.jdbc_url("h", 8000, "db", connect_timeout_ms=1500) == "jdbc:own://h:8000/db?sslmode=prefer&connectTimeout=2"
    assert d.dialect_for("jdbc:postgresql://h/db") is d.POSTGRES_FAMILY
    with pytest.raises(ValueError):
        d.dialect_for("jdbc:other://h/db")
    url = d.replication_url("jdbc:own://h:8000/db?replication=database&", 8001)
    assert url == "jdbc:own://h:8001/db?replication=database&preferQueryMode=simple&assumeMinServerVersion=9.4"
    assert d.slot_options() == {"include-xids": "1", "include-timestamp": "1"} and d.slot_options(4, "J", True)["decode-style"] == "j"
    assert d.parse_boundary(d.snapshot_boundary(7, "00A-1", 255)) == ("00A-1", 255)
    with pytest.raises(ValueError):
        d.snapshot_id("x'; drop")


# --- options

NEEDED = {"hostname": "h", "database": "db", "table-name": "t", "username": "u", "password": "secret"}


def test_cdc_options():
    o = CdcOptions.of(NEEDED | {"decode-style": "J", "wal.mode": "true", "chunk.size": "5"})
    assert (o.port, o.decode_style, o.wal_mode, o.chunk_size, o.schema) == (8000, "j", True, 5, "public") and "secret" not in repr(o)
    assert CdcOptions.of(NEEDED | {"plugin.name": "pgoutput"}).decode_plugin == "pgoutput"
    for bad in ({"port": "x"}, {"chunk.size": 0}, {"parallel-decode-num": 21}, {"decode-style": "q"}, {"nope": 1}, {"hostname": " "}, {"wal.mode": "yes"}, {"plugin.name": "pgoutput", "decode.plugin": "mppdb_decoding"}, {"output.json.format": "xml"}):
        with pytest.raises(OptionError):
            CdcOptions.of(NEEDED | bad)


def test_jdbc_options():
    o = JdbcOptions.of({"url": "jdbc:x", "table-name": "t"})
    assert (o.buffer_rows, o.max_retries, o.ignore_null) == (100, 3, False)
    for bad in ({"scan.partition.num": 4}, {"username": "u"}, {"sink.max-retries": -1}, {"sink.buffer-flush.max-rows": 0}):
        with pytest.raises(OptionError):
            JdbcOptions.of({"url": "jdbc:x", "table-name": "t"} | bad)
    with pytest.raises(OptionError):
        CatalogOptions.of({"username": "u"})


# --- catalog


def test_catalog(spark):
    def read(database, sql):
        if "pg_database" in sql:
            return spark.createDataFrame([("db",), ("template0",)], "datname string")
        if "information_schema.tables" in sql:
            return spark.createDataFrame([("public", "b", "BASE TABLE"), ("public", "a", "BASE TABLE"), ("s", "v", "VIEW"), ("pg_catalog", "p", "BASE TABLE")], "table_schema string, table_name string, table_type string")
        if "PRIMARY KEY" in sql:
            return spark.createDataFrame([("price", 2), ("id", 1)], "c string, place int")
        return spark.createDataFrame([("id", "int8", 64, 0, "NO"), ("price", "numeric", 10, 2, "YES")], "c string, k string, p int, s int, n string")

    c = catalog.Catalog(read, "db")
    assert c.list_databases() == ["db"] and c.list_tables("db") == ["public.a", "public.b"]
    assert c.table_exists("db", "a") and not c.table_exists("db", "s.v") and not c.table_exists("none", "a")
    assert c.table_schema("db", "a") == T.StructType().add("id", "long", False).add("price", T.DecimalType(10, 2))
    assert c.table("db", "a").primary_key == ("id", "price")
    with pytest.raises(catalog.DatabaseNotFoundError):
        c.list_tables("none")
    with pytest.raises(ValueError):
        c.list_tables(" ")
    with pytest.raises(catalog.TableNotFoundError):
        c.table_schema("db", "zz")


# --- transports


class FakeCursor:
    def __init__(self, server):
        self.server, self.description, self.rows = server, None, []

    def execute(self, sql, values):
        self.server.calls.append((sql, values))
        self.rows, self.description = [], ("x",)
        if "pg_replication_slots" in sql:
            self.rows = [(1,)] if self.server.slot else []
        elif "pg_create" in sql:
            self.server.slot = True
            self.rows = [("s", "0/10")]
        elif "peek" in sql:
            limit = int(sql.split("NULL, ")[1].split(",")[0])
            self.rows = self.server.log[:limit]
        elif "pg_replication_slot_advance" in sql:
            raise RuntimeError("no such function")
        elif "pg_logical_replication_slot_advance" in sql:
            self.server.log = [r for r in self.server.log if int(r[0][2:], 16) > int(values[1][2:], 16)]

    def fetchall(self):
        return self.rows

    def close(self):
        pass


class FakeServer:
    def __init__(self):
        self.calls, self.slot, self.log = [], False, [(f"0/{k:X}", "7", f"d{k}") for k in range(1, 8)]

    def cursor(self):
        return FakeCursor(self)

    def rollback(self):
        pass

    def close(self):
        pass


def test_peek_transport():
    server = FakeServer()
    t = transport.PeekTransport(lambda: server, "s", "mppdb_decoding")
    assert t.prepare_slot() == "0/10" and t.exists()
    assert [r[3] for r in t.read(0, 3)] == ["d1", "d2", "d3"] and [r[3] for r in t.read(3, 3)] == ["d4", "d5", "d6"]
    t.ack("0/3")
    assert [r[3] for r in t.read(0, 2)] == ["d4", "d5"]
    t.close()


def test_push_transport_and_fallback():
    flushed = []
    t = transport.PushTransport(lambda start: iter([(f"0/{k}", 1, f"d{k}") for k in range(1, 6)]), flushed.append)
    assert [r[3] for r in t.read(0, 3)] == ["d1", "d2", "d3"] and [r[3] for r in t.read(1, 1)] == ["d2"]
    t.ack("0/2")
    assert flushed == ["0/2"] and [r[3] for r in t.read(0, 5)] == ["d3", "d4", "d5"]

    def broken():
        raise RuntimeError("no push here")

    assert transport.first_that_opens(broken, lambda: t) is t
    with pytest.raises(transport.TransportError):
        transport.first_that_opens(broken)


def test_reconnect_checks_the_schema(tmp_path):
    t, tries = transport.FileTransport(str(tmp_path)), []

    def call(_):
        tries.append(1)
        if len(tries) < 2:
            raise ConnectionError
        return "done"

    assert transport.with_reconnect(t, call, lambda: {"t": ["a"]}, {"t": ["a"]}) == "done"
    tries.clear()
    with pytest.raises(transport.TransportError, match="other columns"):
        transport.with_reconnect(t, call, lambda: {"t": ["a", "b"]}, {"t": ["a"]})
    assert transport.discover_tables([("public", "b1"), ("public", "a"), ("x", "b2")], "public", "b.") == [("public", "b1")]


# --- streaming


def write_log(folder, name, rows):
    (folder / name).write_text("".join(json.dumps(dict(zip(("pos", "lsn", "xid", "data"), r, strict=True))) + "\n" for r in rows))


def test_stream_restarts_behind_its_checkpoint(spark, tmp_path):
    from tidewire.functions.records import parse_records

    spark.dataSource.register(LogSource)
    log, out = tmp_path / "log", str(tmp_path / "out")
    log.mkdir()
    insert = '{"table_name":"public.t","op_type":"INSERT","columns_name":["id"],"columns_type":["bigint"],"columns_val":["%d"]}'
    first = [(1, "0/1", 7, "BEGIN 7"), (2, "0/2", 7, insert % 1), (3, "0/3", 8, "BEGIN 8"), (4, "0/4", 8, insert % 2), (5, "0/5", 8, "COMMIT 8 CSN 5")]
    write_log(log, "1.jsonl", first)
    assert spark.read.format("tidewire-log").option("path", str(log)).load().count() == 5

    def run():
        stream = spark.readStream.format("tidewire-log").option("path", str(log)).option("maxRowsPerBatch", "2").load()
        q = reassemble_stream(parse_records(stream)).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).start(out)
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return [r["pos"] for r in spark.read.parquet(out).orderBy("txn", "pos").collect()]

    assert run() == []  # the transaction that began first is open
    write_log(log, "2.jsonl", [(6, "0/6", 7, "COMMIT 7 CSN 6")])
    assert run() == [2, 4]


# --- snapshot and log in one stream

SERVER = {}


class StandInCursor:
    """A server's answers: its catalog and tables from sqlite, its slot from a list."""

    def __init__(self, server):
        self.server, self.description, self.rows = server, ("x",), []

    def execute(self, sql, values=()):
        s = self.server
        s["calls"].append((sql, tuple(values)))
        if s["fail"]:
            s["fail"] -= 1
            raise ConnectionError("gone")
        if "information_schema.tables" in sql:
            self.rows = [("public", "t"), ("public", "other"), ("x", "t")]
        elif "PRIMARY KEY" in sql:
            self.rows = [("id",)]
        elif "information_schema.columns" in sql:
            self.rows = s["columns"]
        elif "pg_replication_slots" in sql:
            self.rows = [(1,)] if s["slot"] else []
        elif "pg_create" in sql:
            s["slot"], self.rows = True, [("slot", "0/1")]
        elif "peek" in sql:
            self.rows = s["log"][: int(sql.split("NULL, ")[1].split(",")[0])]
        elif "advance" in sql:
            s["acked"].append(values[1])
            s["log"] = [r for r in s["log"] if int(r[0][2:], 16) > int(values[1][2:], 16)]
        elif sql.startswith("SELECT"):
            after = values[0] if values else 0
            self.rows = [r for r in s["table"] if r[0] > after][: int(sql.rsplit(" ", 1)[1])]

    def fetchall(self):
        return self.rows

    def close(self):
        pass


class StandIn:
    def cursor(self):
        return StandInCursor(SERVER)

    def rollback(self):
        pass

    def close(self):
        pass


def connect():
    return StandIn()


def insert(k):
    from tidewire.functions.records import json_record

    return json_record("public.t", "INSERT", [("id", "bigint", str(k)), ("v", "text", "new")])


@pytest.fixture
def server():
    log = [("BEGIN 7",), (insert(11),), ("BEGIN 8",), (insert(12),), ("COMMIT 8 CSN 5",), (insert(12).replace("public.t", "public.zz"),), ("COMMIT 7 CSN 6",)]
    SERVER.clear()
    SERVER.update(calls=[], fail=0, slot=False, acked=[], columns=[("id", "bigint"), ("v", "text")], table=[(k, f"v{k}") for k in range(1, 6)])
    SERVER["log"] = [(f"0/{16 + k:X}", "8" if k in (2, 3, 4) else "7", d) for k, (d,) in enumerate(log)]
    return SERVER


CAPTURE = NEEDED | {"table-name": "t", "wal.mode": "true", "chunk.size": "2", "slot.name": "s", "connect": f"{__name__}:connect", "maxRowsPerBatch": "3"}


def reader(**more):
    return capture.ChangeReader(*capture.parsed_options(CAPTURE | more))


def drain(r, at):
    out = []
    while True:
        rows, end = r.read(at)
        rows = list(rows)
        if not rows:
            return out, at
        out.append((rows, end))
        at = end


def test_snapshot_then_log_and_acknowledgement(server):
    r = reader()
    batches, end = drain(r, r.initialOffset())
    rows = [x for b, _ in batches for x in b]
    assert [len(b) for b, _ in batches] == [2, 2, 1, 3, 3, 1]
    first = next(i for i, (sql, _) in enumerate(server["calls"]) if "FROM " + '"public"."t"' in sql)
    assert any("pg_create" in sql for sql, _ in server["calls"][:first])  # the slot comes before the snapshot
    assert [x[3] for x in rows[:5]] == [-1] * 5 and [x[1] for x in rows] == list(range(12)) and rows[5][4] == "BEGIN 7"
    assert server["acked"] == [] and [e.get("after") for _, e in batches] == [0, 0, 0, 3, 6, 0]
    for _, e in batches:
        r.commit(e)
    assert server["acked"] == ["0/16"] and server["log"] == []
    server["log"] = [("0/20", "9", "BEGIN 9"), ("0/21", "9", "COMMIT 9 CSN 9")]
    more, _ = drain(r, end)
    assert [x[4] for x in more[0][0]] == ["BEGIN 9", "COMMIT 9 CSN 9"]


def test_file_log_goes_on_behind_what_was_acknowledged(tmp_path, monkeypatch):
    lines = [{"pos": k, "lsn": f"0/{k:X}", "xid": 1, "data": str(k)} for k in (1, 3, 2, 4, 6, 5, 7, 8, 9)]
    (tmp_path / "a.json").write_text("".join(json.dumps(x) + "\n" for x in lines[:5]))
    (tmp_path / "b.json").write_text("".join(json.dumps(x) + "\n" for x in lines[5:]))
    parsed, loads = [], transport.json.loads
    monkeypatch.setattr(transport.json, "loads", lambda text: parsed.append(1) or loads(text))
    t = transport.FileTransport(str(tmp_path))
    assert [r[0] for r in t.read(0, 3)] == [1, 3, 2]
    t.ack("0/2")  # 3 stays
    assert [r[0] for r in t.read(1, 3)] == [4, 6, 5] and len(parsed) == 6
    t.ack("0/5")  # 6 stays
    assert [r[0] for r in t.read(1, 9)] == [7, 8, 9] and len(parsed) == 9
    assert [r[0] for r in t.read(0, 9)] == [6, 7, 8, 9]  # asked from the front again


def test_snapshot_pages_fill_a_batch(server):
    batches, end = drain(r := reader(maxRowsPerBatch="4"), r.initialOffset())
    assert [len(b) for b, _ in batches][:2] == [4, 1] and [x[1] for b, _ in batches for x in b] == list(range(12))
    assert [x[1] for x in reader(maxRowsPerBatch="4").readBetweenOffsets(r.initialOffset(), batches[0][1])] == [0, 1, 2, 3]
    rows, _ = reader(maxRowsPerBatch="4").read(batches[0][1])
    assert [x[1] for x in rows] == [4]


def test_restart_before_and_after_acknowledgement(server):
    r = reader(**{"snapshot.mode": "false"})
    batches, _ = drain(r, r.initialOffset())
    (rows1, end1), (rows2, end2), (rows3, end3) = batches
    again = reader(**{"snapshot.mode": "false"})  # nothing was acknowledged
    assert list(again.readBetweenOffsets(end1, end2)) == rows2
    found, end = drain(again, end2)
    assert [x for b, _ in found for x in b] == rows3 and end == end3
    again.commit(end)
    assert server["acked"] == ["0/16"]
    third = reader(**{"snapshot.mode": "false"})
    assert drain(third, end) == ([], end)


def test_snapshot_goes_on_at_its_page(server):
    r = reader()
    _, end = r.read(r.initialOffset())
    rows, _ = reader().read(end)
    assert [json.loads(x[4])["columns_val"][0] for x in rows] == ["3", "4"]
    assert [x[1] for x in reader().readBetweenOffsets(r.initialOffset(), end)] == [0, 1]


def test_lost_connections_and_changed_columns(server):
    r = reader(**{"snapshot.mode": "false"})
    (rows, end) = r.read(r.initialOffset())
    server["fail"] = 1
    again, _ = r.read(end)
    assert [x[4] for x in again][1].startswith("COMMIT 8") and len(list(rows)) == 3
    server["fail"], server["columns"] = 1, [("id", "bigint")]
    with pytest.raises(transport.TransportError, match="other columns"):
        r.read(end)


def test_push_is_tried_first(server):
    r = reader(push=f"{__name__}:send", **{"snapshot.mode": "false", "parallel-decode-num": "4"})
    assert isinstance(r.transport, transport.PushTransport) and [x[4] for x in r.read(r.initialOffset())[0]] == ["BEGIN 1"]
    assert isinstance(reader(push=f"{__name__}:no_push").transport, transport.PeekTransport)
    for bad in ({"connect": ""}, {"wal.mode": "false"}, {"connect": "nothing"}):
        with pytest.raises(OptionError):
            reader(**bad)


def send(start, options):
    assert options["parallel-decode-num"] == "4"
    return iter([("0/1", 1, "BEGIN 1")])


def no_push(start, options):
    raise RuntimeError("no push here")


def test_change_stream_over_files(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "snapshot").mkdir()
    write_log(tmp_path / "snapshot", "1.jsonl", [(k, "0/0", 0, insert(k)) for k in range(5)])
    data = ["BEGIN 7", insert(11), "BEGIN 8", insert(12), "COMMIT 8 CSN 5", insert(13).replace("public.t", "public.zz"), "COMMIT 7 CSN 6"]
    write_log(tmp_path / "log", "1.jsonl", [(k, f"0/{16 + k:X}", 8 if k in (2, 3, 4) else 7, d) for k, d in enumerate(data)])
    options = {k: v for k, v in CAPTURE.items() if k != "connect"} | {"path": str(tmp_path)}

    def run(name, **more):
        q = capture.change_stream(spark, options | more, ["id"]).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return spark.table(name).orderBy("txn", "pos").collect()

    rows = run("raw_changes")
    assert [(r["op"], r["after"][0]["value"]) for r in rows] == [*(("r", str(k)) for k in range(5)), ("c", "11"), ("c", "12")]
    events = [json.loads(r["event"]) for r in run("json_changes", **{"output.format": "json", "output.json.format": "he"})]
    assert [e["pkValues"] for e in events] == [[str(k)] for k in (0, 1, 2, 3, 4, 11, 12)] and "lsn" not in events[0] and events[5]["lsn"] == "0/11"


def test_readers_share_an_exported_snapshot(spark, tmp_path, monkeypatch):
    import sqlite3

    import standin

    from tidewire.functions.records import parse_records
    from tidewire.sources import exported

    monkeypatch.setenv("TIDEWIRE_STANDIN", str(tmp_path))
    db = sqlite3.connect(tmp_path / "db")
    db.execute("create table t(id integer, v text)")
    db.executemany("insert into t values (?, ?)", [(k, None if k == 3 else f"v'{k}") for k in range(1, 8)])
    db.commit()
    for server, csn in ((standin.best, 41), (standin.second, 41), (standin.plain, -1)):
        with exported.exported(server, 7) as found:
            assert found == exported.Exported("00A-1", csn)
    with pytest.raises(RuntimeError, match="group 7"), exported.exported(standin.busy, 7):
        pass
    calls = (tmp_path / "calls").read_text().splitlines()
    assert calls[0] == "SELECT pg_try_advisory_lock(7)" and calls[-2:] == ["ROLLBACK", "CLOSE"] and calls.count("SELECT pg_advisory_unlock(7)") == 3
    options = {"connect": "standin:best", "schema": "public", "table": "t", "key": "id", "columns": "id:bigint,v:text", "splits": "3", "low": "1", "high": "7"}
    reader = exported._SnapshotReader(options | {"snapshot": "00A-1"})
    parts = reader.partitions()
    assert [(p.low, p.high) for p in parts] == [(1, 2), (3, 4), (5, 7)]
    rows = [r for p in parts for r in reader.read(p)]
    assert [r[1] for r in rows] == [0, 1, 1 << 40, (1 << 40) + 1, 2 << 40, (2 << 40) + 1, (2 << 40) + 2] and {r[3] for r in rows} == {-1}
    parsed = parse_records(spark.createDataFrame(rows, exported.SCHEMA)).orderBy("pos").collect()
    assert [[c["value"] for c in r["after"]] for r in parsed] == [[str(k), None if k == 3 else f"v'{k}"] for k in range(1, 8)]
    with pytest.raises(RuntimeError, match="outside"):
        list(exported._SnapshotReader(options).read(parts[0]))
    with pytest.raises(OptionError):
        exported._SnapshotReader({"connect": "standin:best"})


def test_polling_keeps_its_state(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidewire.streaming import polling

    make = lambda rows: spark.createDataFrame(rows, "id long, v string, s long").select("id", "v", F.timestamp_seconds("s").cast("timestamp_ntz").alias("updated_at"))
    state, seen, now = str(tmp_path / "state"), [], {}

    def sink(changes, cycle):
        seen.append((cycle, sorted((r["_phase"], r["_op"], r["id"]) for r in changes.collect())))

    def cycle(rows, **more):
        now["rows"] = rows
        return polling.poll(spark, lambda: make(now["rows"]), sink, state, "id", "updated_at", 2, **more)

    a = [(1, "a", 1), (2, "b", 1), (3, "c", 1)]
    assert cycle(a) == 0 and seen[-1] == (0, [(0, "r", 1), (0, "r", 2), (0, "r", 3)])
    b = [(1, "A", 5), (3, "c", 1), (4, "d", 5), (5, "e", 5), (6, "f", 0)]
    assert cycle(b) == 1 and seen[-1] == (1, [(1, "c", 4), (1, "u", 1), (2, "c", 5), (3, "d", 2)])
    first = seen[-1]

    def broken(changes, number):
        sink(changes, number)
        raise RuntimeError("cut short")

    now["rows"] = b
    with pytest.raises(RuntimeError):
        polling.poll(spark, lambda: make(b), broken, state, "id", "updated_at", 2)
    cut = seen.pop()
    assert cycle(b) == 2 and seen[-1] == cut == (2, [(1, "u", 5), (2, "c", 6)]) and first[0] == 1
    assert cycle(b) == 3 and seen[-1] == (3, [])
    known, cursor = polling.PollState(spark, state).load(3)
    assert sorted(r["id"] for r in known.collect()) == [1, 3, 4, 5, 6] and (cursor.last_key, cursor.last_update_key) == (6, 5) and cursor.last_time.year == 1970
    assert polling.PollState(spark, state).versions() == [2, 3]


# --- JDBC


@pytest.fixture(scope="module")
def derby(spark, tmp_path_factory):
    return f"jdbc:derby:{tmp_path_factory.mktemp('db') / 'd'};create=true"


def test_jdbc_scan_append_merge(spark, derby):
    options = JdbcOptions(url=derby, table_name="people", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    people = spark.createDataFrame([(1, "Alice", 20), (2, "Bob", 25)], "id int, name string, age int")
    jdbc.append(people, options)
    back = jdbc.scan(spark, options)
    assert back.count() == 2
    plan = back.filter("ID = 2").select("NAME")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(id), *EqualTo(id,2)]" in plan  # the writer keeps the names as they are
    split = JdbcOptions(url=derby, table_name="people", driver=options.driver, partition_column="ID", partition_num=2, lower_bound=1, upper_bound=3)
    assert jdbc.scan(spark, split).rdd.getNumPartitions() == 2
    new = spark.createDataFrame([(1, "Alice", None), (3, "Cy", 3)], "id int, name string, age int")
    keep_null = JdbcOptions(url=derby, table_name="people", driver=options.driver, ignore_null=True)
    quoted = d.Dialect(name="derby", prefix="jdbc:derby:", mark='"')
    jdbc.merge_staged(new, keep_null, ["id"], jdbc.driver_execute(spark, derby), "staged", quoted)
    assert sorted(map(tuple, jdbc.scan(spark, options).collect())) == [(1, "Alice", 20), (2, "Bob", 25), (3, "Cy", 3)]


def test_changes_reach_a_database(spark, tmp_path):
    """Upserts, deletes and retries through a DB-API connection; sqlite's upsert has its own text."""
    import sqlite3

    path = str(tmp_path / "x.db")
    sqlite3.connect(path).execute("create table t(id integer primary key, name text, age int)").connection.close()

    def connect():
        import sqlite3

        return sqlite3.connect(path, timeout=30)

    sql = "insert into t(id, name, age) values (?, ?, ?) on conflict(id) do update set name = excluded.name, age = excluded.age"
    options = JdbcOptions(url="jdbc:postgresql://h/db", table_name="t", buffer_rows=2, parallelism=2)
    changes = spark.createDataFrame([("c", 1, "a", 1, 1), ("u", 1, "b", 2, 2), ("c", 2, "x", 1, 3), ("d", 2, None, None, 4), ("c", 3, "y", 9, 5)], "_op string, id int, name string, age int, _pos int")
    for _ in range(2):  # twice gives the same
        jdbc.write_changes(changes, connect, options, ["id"], ["_pos"], upsert_sql=sql)
    assert sqlite3.connect(path).execute("select * from t order by id").fetchall() == [(1, "b", 2), (3, "y", 9)]
    with pytest.raises(ValueError):
        jdbc.write_changes(changes, connect, options, ["id"], [], upsert_sql=sql)


def test_batches_by_size_and_time():
    clock = iter([0, 0, 0.4, 1.1, 1.1, 1.2, 1.3])
    assert list(jdbc._in_batches("abcde", 3, 1, lambda: next(clock, 9))) == [["a", "b"], ["c", "d", "e"]]
    assert list(jdbc._in_batches("abcde", 2)) == [["a", "b"], ["c", "d"], ["e"]] and list(jdbc._in_batches("", 2)) == []


def test_writes_are_tried_again_within_their_time():
    tries = []

    def connect():
        tries.append(1)
        raise ConnectionError

    for retries, timeout, n in ((2, 60, 3), (5, 0, 1)):
        tries.clear()
        with pytest.raises(ConnectionError):
            jdbc._write(connect, "", [], retries, timeout)
        assert len(tries) == n


def test_keyset_pages(spark):
    spark.range(10).selectExpr("id", "id div 4 ts").createOrReplaceTempView("kp")

    def read(sql, values):
        for v in values:
            sql = sql.replace("?", str(v), 1)
        return spark.sql(sql)

    pages = jdbc.keyset_pages(read, d.POSTGRES_FAMILY, "kp", ["id", "ts"], ["id"], 4)
    assert [p.count() for p in pages] == [4, 4, 2]
    spark.range(10).selectExpr("id", "timestamp_seconds(id div 4 + 1) ts").createOrReplaceTempView("kt")
    pages = jdbc.keyset_pages(lambda sql, values: spark.sql(sql, args=values), d.POSTGRES_FAMILY, "kt", ["id", "ts"], ["ts", "id"], 3)
    assert [[r["id"] for r in p.collect()] for p in pages] == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9]]
