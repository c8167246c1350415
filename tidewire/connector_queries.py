"""Queries over the connectors: JDBC scans and sinks on an embedded database, the catalog, SQL and addresses, polling with
saved state, and capture from snapshot to log; with the SQL that gives the same rows."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dialect as d
from .functions import envelopes, lsn
from .functions.options import CatalogOptions, CdcOptions, JdbcOptions
from .operators import changelog as cl
from .operators import transactions as tx
from .plans import snapshots, stage
from .queries import _IMAGES, _NEW, _PREFIX, _STATES, _WAL, _customers, _events, _states, query, table, wal, wal_text
from .sources import catalog, jdbc
from .streaming import capture, polling
from .streaming.log_source import LogSource

_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
_OWN = d.Dialect(name="embedded", prefix="jdbc:derby:", drivers=(_DRIVER,), mark='"')


def _new_database() -> str:
    """The address of a new embedded database in the driver's own temporary folder."""
    folder = tempfile.mkdtemp(prefix="tidewire-database-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"jdbc:derby:{folder}/{uuid.uuid4().hex};create=true"


def _embedded(rows: DataFrame, name: str, **more) -> JdbcOptions:
    """``rows`` appended to a table of a new embedded database."""
    options = JdbcOptions(url=_new_database(), table_name=name, driver=_DRIVER, **more)
    jdbc.append(rows, options)
    return options


def _upper(rows: DataFrame) -> DataFrame:
    return rows.select(*(F.col(c).alias(c.upper()) for c in rows.columns))


def _lower(rows: DataFrame) -> DataFrame:
    return rows.select(*(F.col(c).alias(c.lower()) for c in rows.columns))


# --- JDBC scans and sinks


@query("select c_custkey, c_name, c_acctbal from customer")
def scan_jdbc(spark, sf):
    options = _embedded(_upper(table(spark, sf, "customer")), "customers", fetch_size=500)
    return _lower(jdbc.scan(spark, options).select("C_CUSTKEY", "C_NAME", "C_ACCTBAL"))


@query("select s_suppkey, s_acctbal from supplier union all select s_suppkey, s_acctbal from supplier where s_suppkey <= 10")
def table_by_options(spark, sf):
    """A table named by options alone: rows appended twice, and read."""
    options = {"url": _new_database(), "table-name": "suppliers", "driver": _DRIVER, "sink.buffer-flush.max-rows": "50", "scan.fetch-size": "20"}
    rows = _upper(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"))
    jdbc.write_table(rows, options)
    jdbc.write_table(rows.filter("S_SUPPKEY <= 10"), options)
    return _lower(jdbc.read_table(spark, options))


@query("select c_custkey, c_nationkey from customer where c_custkey > 100 and c_nationkey in (3, 7)")
def scan_jdbc_pushdown(spark, sf):
    options = _embedded(_upper(table(spark, sf, "customer")), "customers")
    return _lower(jdbc.scan(spark, options).filter("C_CUSTKEY > 100 and C_NATIONKEY in (3, 7)").select("C_CUSTKEY", "C_NATIONKEY"))


@query("select c_nationkey, count(*) as n, 4 as tasks from customer group by c_nationkey")
def scan_jdbc_partitioned(spark, sf):
    own = _embedded(_upper(table(spark, sf, "customer").select("c_custkey", "c_nationkey")), "customers")
    rows = jdbc.scan(spark, JdbcOptions(url=own.url, table_name="customers", driver=_DRIVER, partition_column="C_NATIONKEY", partition_num=4, lower_bound=0, upper_bound=24))
    return _lower(rows.groupBy("C_NATIONKEY").agg(F.count("*").alias("n"))).withColumn("tasks", F.lit(rows.rdd.getNumPartitions()))


@query("with m as (select min(c_custkey) a, (max(c_custkey) - min(c_custkey) + 1) // 3 size from customer) select c_custkey, c_name, cast(least((c_custkey - a) // size, 2) as integer) as split from customer, m")
def snapshot_jdbc_ranges(spark, sf):
    """A range of keys for each task."""
    own = _embedded(_upper(table(spark, sf, "customer").select("c_custkey", "c_name")), "customers")
    return _lower(snapshots.read_snapshot(spark, own.url, "customers", "C_CUSTKEY", 3, {"driver": _DRIVER}).withColumn("split", F.spark_partition_id()))


@query("select n_name, n_regionkey from nation order by n_name")
def snapshot_jdbc_ordered(spark, sf):
    """A key that is no whole number: one task, in the order of the key."""
    own = _embedded(_upper(table(spark, sf, "nation").select("n_name", "n_regionkey")), "nations")
    return _lower(snapshots.read_snapshot(spark, own.url, "nations", "N_NAME", 3, {"driver": _DRIVER}))


def _merged(spark, sf, ignore_null: bool) -> DataFrame:
    stored, new = _customers(spark, sf)
    options = _embedded(stored, "customers", ignore_null=ignore_null)
    execute = jdbc.driver_execute(spark, options.url)
    execute('CREATE UNIQUE INDEX customers_key ON customers ("c_custkey")')  # a table that is merged into by key has one
    jdbc.merge_staged(new, options, ["c_custkey"], execute, "staged", _OWN)
    return jdbc.scan(spark, options)


@query(f"with {_NEW} select c_custkey, c_name, c_mktsegment from customer where c_custkey not in (select c_custkey from new) union all select * from new")
def sink_jdbc_merge(spark, sf):
    return _merged(spark, sf, False)


@query(f"with {_NEW} select coalesce(n.c_custkey, c.c_custkey) as c_custkey, coalesce(n.c_name, c.c_name) as c_name, coalesce(n.c_mktsegment, c.c_mktsegment) as c_mktsegment from customer c full join new n on n.c_custkey = c.c_custkey")
def sink_jdbc_merge_ignore_null(spark, sf):
    return _merged(spark, sf, True)


@query("select c_custkey as id, case when c_custkey % 3 = 0 then lower(c_name) else c_name end as name from customer where c_custkey % 5 <> 0")
def sink_changes(spark, sf):
    """Created, updated and deleted rows, in batches through a DB-API connection, written twice."""
    import sqlite3

    path = f"{stage.shared_path(spark, 'sink').removeprefix('file:')}.db"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    sqlite3.connect(path).execute("create table customers(id integer primary key, name text)").connection.close()

    def connect():
        import sqlite3

        return sqlite3.connect(path, timeout=60)

    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    made = c.select(F.lit("c").alias("_op"), "id", "name", F.lit(1).alias("_pos"))
    changed = c.filter("id % 3 = 0").select(F.lit("u").alias("_op"), "id", F.lower("name").alias("name"), F.lit(2).alias("_pos"))
    gone = c.filter("id % 5 = 0").select(F.lit("d").alias("_op"), "id", "name", F.lit(3).alias("_pos"))
    options = {"url": "jdbc:postgresql://h/db", "table-name": "customers", "sink.parallelism": "1"}
    sql = "insert into customers(id, name) values (?, ?) on conflict(id) do update set name = excluded.name"
    for _ in range(2):
        jdbc.write_table(made.unionByName(changed).unionByName(gone), options, ["id"], ["_pos"], connect, upsert_sql=sql)
    rows = sqlite3.connect(path).execute("select id, name from customers").fetchall()
    os.remove(path)
    return spark.createDataFrame(rows, "id long, name string")


# --- addresses, SQL and names, as functions over rows


def _text(f, *columns: str) -> Column:
    return F.udf(f, "string")(*columns)


@query("select n_nationkey, 'jdbc:postgresql://' || lower(n_name) || ':' || (9000 + n_nationkey) || '/db?' || case when n_nationkey % 2 = 0 then 'replication=database&preferQueryMode=simple' else 'ssl=1&replication=database&preferQueryMode=simple' end || '&assumeMinServerVersion=9.4' as url from nation")
def replication_urls(spark, sf):
    make = lambda n, k: d.replication_url(f"jdbc:postgresql://{n.lower()}:8000/db?{'replication=database&' if k % 2 == 0 else 'ssl=1?&'}", 9000 + k)
    return table(spark, sf, "nation").select("n_nationkey", _text(make, "n_name", "n_nationkey").alias("url"))


@query("select n_nationkey, case when n_nationkey <= 1 then 'include-timestamp=1,include-xids=1' else 'decode-style=j,include-timestamp=1,include-xids=1,parallel-decode-num=' || n_nationkey || case when n_nationkey % 2 = 0 then ',sending-batch=1' else '' end end as options from nation")
def slot_option_rows(spark, sf):
    make = lambda k: ",".join(f"{a}={b}" for a, b in sorted(d.slot_options(k, "J", k % 2 == 0).items()))
    return table(spark, sf, "nation").select("n_nationkey", _text(make, "n_nationkey").alias("options"))


@query("select n_nationkey, 'jdbc:postgresql://h:' || (8000 + n_nationkey) || '/' || n_name || '?sslmode=prefer&connectTimeout=' || greatest(1, cast(ceil(n_nationkey * 700 / 1000.0) as bigint)) as url from nation")
def jdbc_urls(spark, sf):
    make = lambda n, k: d.POSTGRES_FAMILY.jdbc_url("h", 8000 + k, n, connect_timeout_ms=k * 700)
    return table(spark, sf, "nation").select("n_nationkey", _text(make, "n_name", "n_nationkey").alias("url"))


@query("select n_nationkey, case n_nationkey % 3 when 0 then true when 1 then n_nationkey % 2 = 0 else false end as accepted, case when n_nationkey % 2 = 0 then 'own.Driver' when n_nationkey % 5 = 0 then 'sibling.Driver' else 'own.Driver' end as driver from nation")
def dialect_urls(spark, sf):
    """A product's own addresses always, a sibling's only with its own driver at hand; and the driver that is taken."""
    own = d.Dialect(name="own", prefix="jdbc:own:", drivers=("own.Driver", "sibling.Driver"), sibling_prefix="jdbc:postgresql:")
    there = lambda k: lambda c: c == "own.Driver" and k % 2 == 0 or c == "sibling.Driver" and k % 5 == 0
    accepted = F.udf(lambda k: own.accepts_url(["jdbc:own://h/db", "jdbc:postgresql://h/db", "jdbc:other://h/db"][k % 3], there(k)), "boolean")
    return table(spark, sf, "nation").select("n_nationkey", accepted("n_nationkey").alias("accepted"), _text(lambda k: own.default_driver(there(k)), "n_nationkey").alias("driver"))


@query("select event_id, case when event_id % 2 = 0 then printf('%X-1', event_id) end as snapshot from events")
def snapshot_ids(spark, sf):
    """Names of snapshots that may stand in SQL; null for others."""

    def checked(text):
        try:
            return d.snapshot_id(text)
        except ValueError:
            return None

    text = F.format_string("%X-1", F.col("event_id"))
    return table(spark, sf, "events").select("event_id", F.udf(checked, "string")(F.when(F.col("event_id") % 2 == 0, text).otherwise(F.concat(text, F.lit("'; --")))).alias("snapshot"))


@query("select event_id, 'snapshot_' || user_id || ':' || printf('%X-1', event_id) || ':' || printf('%X', event_id * 7) as boundary, event_id * 7 as csn from events")
def snapshot_boundaries(spark, sf):
    """What a reader tells the others about the common snapshot, and read again."""
    told = F.udf(lambda g, e: d.snapshot_boundary(g, f"{e:X}-1", e * 7), "string")("user_id", "event_id")
    rows = table(spark, sf, "events").select("event_id", told.alias("boundary"))
    return rows.select("event_id", "boundary", F.udf(lambda t: d.parse_boundary(t)[1], "long")("boundary").alias("csn"))


@query("select event_id, case event_id % 4 when 0 then event_id when 1 then event_id when 2 then case when regexp_matches(printf('%x', event_id), '[a-f]') then event_id else cast(printf('%x', event_id) as bigint) end end as csn from events")
def csn_texts(spark, sf):
    """Decimal, with a prefix, hexadecimal by its letters, and none of these."""
    e = F.col("event_id")
    text = F.when(e % 4 == 0, e.cast("string")).when(e % 4 == 1, F.concat(F.lit("0x"), F.lower(F.hex(e)))).when(e % 4 == 2, F.lower(F.hex(e))).otherwise(F.concat(F.lit("z"), e))
    return table(spark, sf, "events").select("event_id", lsn.parse_csn(text).cast("long").alias("csn"))


@query("select 'probe' as what, 'SELECT EXISTS (SELECT 1 FROM pg_proc p JOIN pg_namespace n ON n.oid = p.pronamespace WHERE p.proname = ''pg_current_csn'')' as sql union all select 'lock', 'SELECT pg_try_advisory_lock(7)' union all select 'unlock', 'SELECT pg_advisory_unlock(7)' union all select 'import 0', 'BEGIN TRANSACTION ISOLATION LEVEL REPEATABLE READ' union all select 'import 1', 'SET TRANSACTION SNAPSHOT ''0A-1''' union all select 'peek', 'SELECT * FROM pg_logical_slot_peek_changes(?, NULL, 5, ''include-xids'', ''1'', ''parallel-decode-num'', ''4'')'")
def metadata_sql(spark, sf):
    texts = {"probe": d.function_exists("pg_current_csn"), "lock": d.advisory_lock(7), "unlock": d.advisory_lock(7, False), "peek": d.peek_sql(5, 4)}
    texts |= {f"import {k}": sql for k, sql in enumerate(d.import_snapshot("0A-1"))}
    return spark.createDataFrame(sorted(texts.items()), "what string, sql string")


@query("select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')")
def exists_semijoin(spark, sf):
    asked = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(asked, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("select * from (values ('port', '8000'), ('schema', 'public'), ('output_format', 'raw'), ('json_format', 'debezium'), ('snapshot_mode', 'True'), ('chunk_size', '1000'), ('connect_timeout_ms', '30000'), ('poll_interval_ms', '1000'), ('decode_plugin', 'mppdb_decoding'), ('parallel_decode_num', '1'), ('decode_style', 'b'), ('sending_batch', 'False'), ('wal_mode', 'False'), ('sslmode', 'prefer')) v(name, value)")
def capture_option_defaults(spark, sf):
    names = ["port", "schema", "output_format", "json_format", "snapshot_mode", "chunk_size", "connect_timeout_ms", "poll_interval_ms", "decode_plugin", "parallel_decode_num", "decode_style", "sending_batch", "wal_mode", "sslmode"]
    found = CdcOptions.of({"hostname": "h", "database": "db", "table-name": "t", "username": "u", "password": "p"})
    return spark.createDataFrame([(n, str(getattr(found, n))) for n in names], "name string, value string")


# --- catalog


def _server(spark: SparkSession, sf: str) -> catalog.Catalog:
    """A catalog whose databases are the regions, and whose tables are the nations: views where the key is odd."""
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")

    def read(database: str, sql: str) -> DataFrame:
        if "pg_database" in sql:
            return regions.select(F.lower("r_name").alias("datname")).unionByName(spark.createDataFrame([("template0",)], "datname string"))
        if "information_schema.tables" in sql:
            own = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).filter(F.lower("r_name") == database)
            return own.select(F.lit("public").alias("table_schema"), F.lower("n_name").alias("table_name"), F.when(F.col("n_nationkey") % 2 == 0, "BASE TABLE").otherwise("VIEW").alias("table_type"))
        if "PRIMARY KEY" in sql:
            return spark.createDataFrame([("day", 2), ("id", 1)], "column_name string, place int")
        return spark.createDataFrame([("id", "int8", 64, 0, "NO"), ("day", "date", 0, 0, "NO"), ("price", "numeric", 10, 2, "YES"), ("tags", "_varchar", 20, 0, "YES")], "c string, k string, p int, s int, n string")

    options = CatalogOptions.of({"default-database": "africa", "username": "u", "password": "p", "base-url": "jdbc:postgresql://h:8000"})
    return catalog.Catalog(read, options.default_database)


@query("select lower(r_name) as db, 'public.' || lower(n_name) as name, n_nationkey % 2 = 0 as found from nation join region on n_regionkey = r_regionkey where n_regionkey <= 1 union all select 'nowhere', 'public.x', false")
def catalog_table_exists(spark, sf):
    """Asked by name of the tables and views of two databases, and of a database that does not exist."""
    server, rows = _server(spark, sf), table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = [(r[0], r[1]) for r in rows.filter("n_regionkey <= 1").select(F.lower("r_name"), F.lower("n_name")).collect()]  # ten or so
    asked = [(db, f"public.{name}", server.table_exists(db, name)) for db, name in names]
    return spark.createDataFrame([*asked, ("nowhere", "public.x", server.table_exists("nowhere", "x"))], "db string, name string, found boolean")


@query("select * from (values ('id', 'bigint', false, 1), ('day', 'date', false, 2), ('price', 'decimal(10,2)', true, null), ('tags', 'array<string>', true, null)) v(name, kind, nullable, key_place)")
def catalog_table_schema(spark, sf):
    server = _server(spark, sf)
    found = server.table("africa", server.list_tables("africa")[0])
    place = {c: k for k, c in enumerate(found.primary_key, 1)}
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable, place.get(f.name)) for f in found.schema], "name string, kind string, nullable boolean, key_place int")


@query("select 'public' as s, lower(n_name) as t from nation where regexp_full_match(lower(n_name), '.*[13579]')")
def table_discovery(spark, sf):
    from .sources.transport import discover_tables

    names = [("public", r[0].lower()) for r in table(spark, sf, "nation").select("n_name").collect()]  # 25 names
    return spark.createDataFrame(discover_tables([*names, ("other", "x1")], "PUBLIC", ".*[13579]"), "s string, t string")


# --- polling


@query("with n as (select s_suppkey, s_nationkey, row_number() over (order by s_nationkey, s_suppkey) rn from supplier) select s_suppkey, s_nationkey, cast((rn - 1) // 7 as integer) as page from n where rn <= 28")
def poll_keyset_pages(spark, sf):
    """The first four pages behind a cursor over two columns, by the SQL that is sent to a server."""
    name = f"suppliers_{uuid.uuid4().hex}"
    table(spark, sf, "supplier").createOrReplaceTempView(name)
    pages = jdbc.keyset_pages(lambda sql, values: spark.sql(sql, args=values), d.POSTGRES_FAMILY, name, ["s_suppkey", "s_nationkey"], ["s_nationkey", "s_suppkey"], 7, start=-1)
    found = None
    for k, page in zip(range(4), pages, strict=False):
        page = page.withColumn("page", F.lit(k))
        found = page if found is None else found.unionByName(page)
    return found


@query(
    _STATES + """, pages as (select id, (row_number() over (order by id) - 1) // 200 + 1 as cycle from current where id > (select last_key from mark)),
i as (select * from pages where cycle <= 2)
select 0 as cycle, 0 as _phase, 'r' as _op, id from known
union all select cast(cycle as integer), 2, 'c', id from i where id not in (select id from known)
union all select 1, 3, 'd', id from known where id not in (select id from current)"""
)
def poll_two_cycles(spark, sf):
    """The snapshot and two cycles, each begun from the state that the one before it saved."""
    known, current, cursor = _states(spark, sf)
    seen: list[DataFrame] = []
    keep = lambda changes, cycle: seen.append(stage.written(changes.select(F.lit(cycle).alias("cycle"), "_phase", "_op", "id"), "polled"))
    folder = stage.shared_path(spark, "poll-state")
    first = (stage.written(known, "known"), cl.Cursor(last_key=cursor.last_key))
    for _ in range(3):
        polling.poll(spark, lambda: current, keep, folder, "id", size=200, start=first)
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


# --- events, transactions and capture


@query(_IMAGES + """select pos, '{"before":' || case when oldj = 'null' then '{}' else oldj end || ',"after":' || case when newj = 'null' then '{}' else newj end || ',"source":{"connector":"tidewire","db":"db","schema":"public","table":"events","lsn":"' || place || '","ts_ms":' || pos || ',"snapshot":false},"op":"' || case letter when 'I' then 'c' when 'U' then 'u' else 'd' end || '","ts_ms":' || pos || ',"transaction":null}' as event from v""")
def env_debezium_empty_objects(spark, sf):
    e = envelopes.debezium(F.col("op"), F.col("before"), F.col("after"), "db", F.col("schema"), F.col("table"), F.col("pos"), F.col("lsn"), empty_object=True)
    return _events(spark, sf).select("pos", e.alias("event"))


@query(_IMAGES + "select pos, true as alike from v")
def env_times(spark, sf):
    """Both times of an event are those of its formatting."""
    e = envelopes.canal(F.col("op"), F.col("before"), F.col("after"), "db", F.col("table"), ["id"], envelopes.now_ms())
    rows = _events(spark, sf).select("pos", e.alias("e"))
    now = F.get_json_object("e", "$.es").cast("long")
    return rows.select("pos", ((now == F.get_json_object("e", "$.ts").cast("long")) & (now > 1_600_000_000_000)).alias("alike"))


@query(_PREFIX + ", s as (select pos + 1 as p from wal where type = 'COMMIT' and pos % 320 > 160), q as (select p from s where not exists (select 1 from t where bp < p and coalesce(cp, 9000000000000000000) > p)), m as (select max(n) n from (select max(cp) n from done union all select max(p) from q)) select 'main' as slot, printf('%X/%X', n // 4294967296, n % 4294967296) as lsn from m")
def txn_stray_commits(spark, sf):
    """COMMITs without a transaction count where nothing before them is open."""
    log = wal(spark, sf)
    stray = log.filter("type = 'COMMIT' and pos % 320 > 160").withColumn("pos", F.col("pos") + 1).withColumn("xid", F.col("xid") + 1_000_000_000).withColumn("lsn", lsn.lsn_text(F.col("pos")))
    return tx.watermark(log.unionByName(stray))


@query(_WAL.replace("{events}", "events") + "select pos, type from wal where pos > 4096 and type in ('INSERT', 'UPDATE', 'DELETE')")
def push_newer_changes(spark, sf):
    """A log that is pushed without markers: what lies behind the last position passes."""
    return tx.newer_changes(wal(spark, sf).filter(tx.is_data()), "0/1000").select("pos", "type")


def _log_files(spark: SparkSession, sf: str) -> str:
    """A folder with the derived log in one file, in its order, and a snapshot of its table."""
    folder = stage.shared_path(spark, "capture")
    wal_text(spark, sf).select("pos", "lsn", "xid", "data").coalesce(1).sortWithinPartitions("pos").write.json(f"{folder}/log")
    text = lambda *v: F.array(*(F.lit(x) if isinstance(x, str) else x for x in v))
    record = F.to_json(F.struct(F.lit("public.events").alias("table_name"), F.lit("INSERT").alias("op_type"), text("id", "kind").alias("columns_name"), text("bigint", "character varying").alias("columns_type"), text(F.col("user_id").cast("string"), "'base'").alias("columns_val")))
    users = table(spark, sf, "events").select("user_id").distinct()
    users.select(F.col("user_id").alias("pos"), F.lit("0/0").alias("lsn"), F.lit(0).alias("xid"), record.alias("data")).coalesce(1).write.json(f"{folder}/snapshot")
    return folder


@query(_WAL.replace("{events}", "events") + "select pos, xid from wal")
def log_files_batch(spark, sf):
    """The log's files as a table, a task for each."""
    spark.dataSource.register(LogSource)
    return spark.read.format("tidewire-log").option("path", f"{_log_files(spark, sf)}/log").load().select("pos", "xid")


@query(_PREFIX + ", l as (select *, row_number() over (partition by pk order by bp desc, pos desc) place from p), base as (select distinct user_id id, 'base' kind from events) select id, kind from base where id not in (select pk from l) union all select pk, kind from l where place = 1 and type <> 'DELETE'")
def cdc_snapshot_then_log(spark, sf):
    """The source by its options: the snapshot, then the log in several batches, to the table that results."""
    folder, out = _log_files(spark, sf), stage.shared_path(spark, "captured")
    options = {"hostname": "h", "database": "db", "table-name": "ev.*", "username": "u", "password": "p", "wal.mode": "true", "chunk.size": "100", "path": folder, "maxRowsPerBatch": "10000"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")  # one slot has one place in the state
    try:
        stream = capture.change_stream(spark, options)
        running = stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").start(f"{out}/rows")
        try:
            running.processAllAvailable()
        finally:
            running.stop()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = spark.read.schema(stream.schema).parquet(f"{out}/rows")
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    changes = rows.select("op", envelopes.value_of(image, "id").cast("long").alias("id"), envelopes.value_of(image, "kind").alias("kind"), F.col("txn").alias("_txn"), F.col("pos").alias("_pos"))
    return cl.materialise(changes, ["id"], ["_txn", "_pos"], "op")
