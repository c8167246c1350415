"""Queries over the test tables, one for each operator, and the SQL that gives the same rows.

The log that most of them read is derived from ``events``: in each block of sixteen events four transactions
interleave and commit in reverse order, and the second lane of the last blocks stays open.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import binary, envelopes, lsn, naming, records
from .functions import types as kinds
from .functions.dialect import POSTGRES_FAMILY, Dialect
from .operators import changelog as cl
from .operators import transactions as tx
from .plans import snapshots, stage
from .sources import catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SNAPSHOT_CSN = 40


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def epoch_ms(c: str) -> Column:
    """Milliseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    t = F.col(c)
    return F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000 + (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("long") * 1000 + (F.date_format(t, "SSS")).cast("long")


# --- the derived log -------------------------------------------------------------------------------------------------

_WAL = """
with e as (select event_id, user_id pk, event_type, cast(floor(event_id/16) as bigint) blk, event_id%4 lane from {events}),
f as (select user_id pk, min(event_id) first_id from {events} group by user_id),
k as (select e.*, e.blk*4+e.lane xid, (select max(blk) from e) mb, f.first_id from e join f on f.pk = e.pk),
d as (select event_id*10 pos, xid, case when event_id=first_id then 'INSERT' when event_type='error' and event_id%7=0 then 'DELETE' else 'UPDATE' end type, pk, event_type kind, cast(0 as bigint) csn from k),
b as (select min(event_id)*10-5 pos, xid, 'BEGIN' type, cast(null as bigint) pk, cast(null as varchar(20)) kind, cast(0 as bigint) csn from k group by xid),
c as (select blk*160+151+(3-lane) pos, xid, 'COMMIT' type, cast(null as bigint) pk, cast(null as varchar(20)) kind, blk*4+(3-lane)+1 csn from k where not (blk>=mb-3 and lane=2) group by blk,lane,xid),
wal as (select * from d union all select * from b union all select * from c)
"""
_PREFIX = (
    _WAL.replace("{events}", "events")
    + """,
b1 as (select xid, min(pos) bp from wal where type='BEGIN' group by xid),
c1 as (select xid, min(pos) cp, min(csn) cc from wal where type='COMMIT' group by xid),
t as (select b1.xid, bp, cp, cc, max(coalesce(cp, 9000000000000000000)) over (order by bp rows between unbounded preceding and current row) bu from b1 left join c1 using (xid)),
done as (select * from t where bu < 9000000000000000000),
p as (select d.*, done.bp, done.cp, done.cc from d join done using (xid))
"""
)


_LOGS: dict[tuple[str, str, str], DataFrame] = {}


def _once(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A derived log is written once in a session, in a file for each core by ranges of its places; the queries read it as they
    would read one that a server wrote."""

    def get(spark: SparkSession, sf: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf, make.__name__)
        if key not in _LOGS:
            rows = make(spark, sf).repartitionByRange(spark.sparkContext.defaultParallelism, "pos")
            _LOGS[key] = stage.written(rows, make.__name__)
        return _LOGS[key]

    return get


@_once
def wal(spark: SparkSession, sf: str) -> DataFrame:
    """The derived log as changes: each data record has the images (id, kind)."""
    rows = spark.sql(_WAL + "select * from wal", events=table(spark, sf, "events"))
    one = lambda name, oid, v: F.struct(F.lit(name).alias("name"), F.lit(oid).alias("type_oid"), v.alias("value"))
    new = F.array(one("id", 20, F.col("pk").cast("string")), one("kind", 1043, F.col("kind")))
    old = F.array(one("id", 20, F.col("pk").cast("string")))
    data = F.col("type").isin(*tx.DATA)
    return rows.select(
        F.lit("main").alias("slot"), "pos", lsn.lsn_text(F.col("pos")).alias("lsn"), "xid", "csn", "type",
        F.when(data, "public").alias("schema"), F.when(data, "events").alias("table"),
        F.when(F.col("type").isin("UPDATE", "DELETE"), old).alias("before"), F.when(F.col("type").isin("INSERT", "UPDATE"), new).alias("after"),
        F.lit(None).cast("string").alias("raw"),
    )


@_once
def wal_text(spark: SparkSession, sf: str) -> DataFrame:
    """The same log as text records: JSON, BEGIN and COMMIT."""
    rows = spark.sql(_WAL + "select * from wal", events=table(spark, sf, "events"))
    strings = lambda *v: F.array(*(F.lit(x) if isinstance(x, str) else x for x in v))
    quoted = F.concat(F.lit("'"), F.replace("kind", F.lit("'"), F.lit("''")), F.lit("'"))
    id_ = F.col("pk").cast("string")
    has_new, has_old = F.col("type") != "DELETE", F.col("type") != "INSERT"
    record = F.to_json(F.struct(
        F.lit("public.events").alias("table_name"), F.col("type").alias("op_type"),
        F.when(has_new, strings("id", "kind")).alias("columns_name"), F.when(has_new, strings("bigint", "character varying")).alias("columns_type"), F.when(has_new, F.array(id_, quoted)).alias("columns_val"),
        F.when(has_old, strings("id")).alias("old_keys_name"), F.when(has_old, strings("bigint")).alias("old_keys_type"), F.when(has_old, F.array(id_)).alias("old_keys_val"),
    ))
    begin = F.concat(F.lit("BEGIN "), F.col("xid"))
    commit = F.concat(F.lit("COMMIT "), F.col("xid"), F.lit(" (at 2025-03-02 04:05:06.7+00) CSN "), F.col("csn"))
    data = F.when(F.col("type") == "BEGIN", begin).when(F.col("type") == "COMMIT", commit).otherwise(record)
    return rows.select(F.lit("main").alias("slot"), "pos", lsn.lsn_text(F.col("pos")).alias("lsn"), "xid", data.alias("data"))


def committed(spark: SparkSession, sf: str) -> DataFrame:
    return tx.committed_prefix(wal(spark, sf), SNAPSHOT_CSN)


# --- relations -------------------------------------------------------------------------------------------------------


@query("select o_orderkey, o_custkey, o_orderstatus from orders")
def scan_project(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("select o_orderkey, o_orderpriority from orders where o_orderstatus = 'O' and o_custkey between 10 and 200")
def scan_filter(spark, sf):
    return table(spark, sf, "orders").filter("o_orderstatus = 'O' and o_custkey between 10 and 200").select("o_orderkey", "o_orderpriority")


@query("select c_mktsegment, count(*) as n, avg(c_nationkey) as avg_nation from customer group by c_mktsegment")
def groupby_count_avg(spark, sf):
    return table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.avg("c_nationkey").alias("avg_nation"))


@query("select c_nationkey, max(c_custkey) as top_key, max(c_name) as top_name, min(c_acctbal) as least_balance from customer group by c_nationkey")
def groupby_insert_select_max(spark, sf):
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(F.max("c_custkey").alias("top_key"), F.max("c_name").alias("top_name"), F.min("c_acctbal").alias("least_balance"))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100")
def order_limit_topk(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


# --- snapshots -------------------------------------------------------------------------------------------------------

_SPLITS = """
with m as (select min(o_orderkey) a, max(o_orderkey) b, (max(o_orderkey) - min(o_orderkey) + 1) // 4 size from orders),
r as (select cast(i as integer) split, a + i * size low, case when i = 3 then b else a + (i + 1) * size - 1 end high from m, range(4) s(i))
"""


@query("select min(o_orderkey) as least, max(o_orderkey) as most, count(*) as n from orders")
def snapshot_minmax(spark, sf):
    return table(spark, sf, "orders").agg(F.min("o_orderkey").alias("least"), F.max("o_orderkey").alias("most"), F.count("*").alias("n"))


@query(_SPLITS + "select split, low, high from r")
def snapshot_split_ranges(spark, sf):
    return snapshots.ranges_frame(table(spark, sf, "orders"), "o_orderkey", 4)


def _splits(spark, sf):
    orders = table(spark, sf, "orders")
    ranges = snapshots.split_ranges(*orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first(), 4)
    return orders.withColumn("split", snapshots.split_of("o_orderkey", ranges))


_SPLIT_COUNTS = _SPLITS + "select split, count(*) as n from r join orders on o_orderkey between low and high group by split"


@query(_SPLIT_COUNTS)
def snapshot_split_row_counts(spark, sf):
    return _splits(spark, sf).groupBy("split").agg(F.count("*").alias("n"))


@query(_SPLITS + "select split, min(o_orderkey) as first_key, max(o_orderkey) as last_key, count(distinct o_custkey) as customers from r join orders on o_orderkey between low and high group by split")
def scan_partitioned_count(spark, sf):
    return _splits(spark, sf).groupBy("split").agg(F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"), F.countDistinct("o_custkey").alias("customers"))


@query("with m as (select min(o_orderkey) a, max(o_orderkey) b from orders) select low, least(low + 999, b) as high from m, range(a, b + 1, 1000) r(low)".replace("from m, range(a, b + 1, 1000) r(low)", "from (select unnest(range(a, b + 1, 1000)) low, b from m)"))
def snapshot_chunks(spark, sf):
    return snapshots.chunks_frame(table(spark, sf, "orders"), "o_orderkey", 1000)


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
_ORDER_JSON = "'{' || " + " || ',' || ".join(f"""'"{c}":"' || {c} || '"'""" for c in _ORDER_COLUMNS) + " || '}'"


def _orders(spark, sf):
    rows = table(spark, sf, "orders").withColumn("ms", epoch_ms("o_orderdate"))
    none = F.array().cast(f"array<{records.COLUMN}>")
    return rows, none, envelopes.image(_ORDER_COLUMNS)


@query(f"""select o_orderkey, '{{"before":null,"after":' || {_ORDER_JSON} || ',"source":{{"connector":"tidewire","db":"db","schema":"public","table":"orders","ts_ms":' || epoch_ms(o_orderdate) || ',"snapshot":true}},"op":"c","ts_ms":' || epoch_ms(o_orderdate) || ',"transaction":null}}' as event from orders""")
def snapshot_envelope_debezium(spark, sf):
    rows, none, image = _orders(spark, sf)
    return rows.select("o_orderkey", envelopes.debezium(F.lit("r"), none, image, "db", "public", "orders", F.col("ms"), snapshot=True).alias("event"))


@query(f"""select o_orderkey, '{{"data":' || {_ORDER_JSON} || ',"old":null,"database":"db","table":"orders","type":"INSERT","pkNames":["o_orderkey"],"es":' || epoch_ms(o_orderdate) || ',"ts":' || epoch_ms(o_orderdate) || ',"isDdl":false,"sqlType":{{}},"mysqlType":{{}}}}' as event from orders""")
def snapshot_envelope_canal(spark, sf):
    rows, none, image = _orders(spark, sf)
    return rows.select("o_orderkey", envelopes.canal(F.lit("r"), none, image, "db", "orders", ["o_orderkey"], F.col("ms")).alias("event"))


@query(f"""select o_orderkey, '{{"database":"db","table":"orders","optType":"INSERT","pkNames":["o_orderkey"],"pkValues":["' || o_orderkey || '"],"es":' || epoch_ms(o_orderdate) || ',"ts":' || epoch_ms(o_orderdate) || ',"data":' || {_ORDER_JSON} || ',"old":null}}' as event from orders""")
def snapshot_envelope_he(spark, sf):
    rows, none, image = _orders(spark, sf)
    return rows.select("o_orderkey", envelopes.he(F.lit("r"), none, image, "db", "orders", ["o_orderkey"], F.col("ms")).alias("event"))


# --- polling ---------------------------------------------------------------------------------------------------------

_STATES = """
with current as (select o_orderkey id, o_orderstatus status, o_orderpriority prio, o_orderdate updated_at from orders where o_orderkey % 11 <> 0),
known as (select o_orderkey id, case when o_orderkey % 5 = 0 then 'X' else o_orderstatus end status, o_orderpriority prio, o_orderdate updated_at from orders where o_orderkey % 7 <> 0),
mark as (select max(id) last_key from known where id < 3000),
tick as (select updated_at t, id k from current order by updated_at, id limit 1 offset 50)
"""


def _states(spark, sf):
    orders = table(spark, sf, "orders")
    current = orders.filter("o_orderkey % 11 <> 0").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("prio"), F.col("o_orderdate").alias("updated_at"))
    status = F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus"))
    known = orders.filter("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("id"), status.alias("status"), F.col("o_orderpriority").alias("prio"), F.col("o_orderdate").alias("updated_at"))
    last = known.filter("id < 3000").agg(F.max("id")).first()[0]
    t = current.orderBy("updated_at", "id").offset(50).limit(1).first()
    return known, current, cl.Cursor(last, t["updated_at"], t["id"])


_INSERT_PAGE = "select * from current where id > (select last_key from mark) order by id limit 200"
_UPDATE_PAGE = "select c.* from current c, tick where updated_at > t or (updated_at = t and id > k) order by updated_at, id limit 200"


@query(_STATES + f"select id, status, prio from ({_INSERT_PAGE})")
def poll_insert_page(spark, sf):
    _, current, cursor = _states(spark, sf)
    return cl.insert_page(current, "id", cursor, 200).select("id", "status", "prio")


@query(_STATES + f"select id, status, prio from ({_UPDATE_PAGE})")
def poll_update_keyset_page(spark, sf):
    _, current, cursor = _states(spark, sf)
    return cl.update_page(current, "id", "updated_at", cursor, 200).select("id", "status", "prio")


@query(_STATES + f"select p.id, case when k.id is null then 'c' else 'u' end as _op, k.status as old_status, p.status from ({_UPDATE_PAGE}) p left join known k on k.id = p.id")
def poll_new_vs_update_classify(spark, sf):
    known, current, cursor = _states(spark, sf)
    found = cl.classify(cl.update_page(current, "id", "updated_at", cursor, 200), known, ["id"])
    return found.select("id", "_op", F.col("before.status").alias("old_status"), F.col("after.status").alias("status"))


@query(_STATES + "select id, status as old_status from known where id not in (select id from current)")
def poll_deletes(spark, sf):
    known, current, _ = _states(spark, sf)
    return cl.missing(known, current, ["id"]).select("id", F.col("before.status").alias("old_status"))


@query(
    _STATES
    + f""", u as ({_UPDATE_PAGE}), i as ({_INSERT_PAGE}), seen as (select id from known union select id from u)
select 1 as _phase, case when k.id is null then 'c' else 'u' end as _op, u.id, k.status as old_status, u.status from u left join known k on k.id = u.id
union all select 2, 'c', id, null, status from i where id not in (select id from seen)
union all select 3, 'd', s.id, coalesce(i.status, u.status, k.status), null from (select id from seen union select id from i) s
  left join i on i.id = s.id left join u on u.id = s.id left join known k on k.id = s.id where s.id not in (select id from current)"""
)
def poll_cycle_all(spark, sf):
    known, current, cursor = _states(spark, sf)
    found = cl.poll_cycle(known, current, "id", cursor, 200, "updated_at")
    return found.select("_phase", "_op", "id", F.col("before.status").alias("old_status"), F.col("after.status").alias("status"))


@query(_STATES + "select max(id) as last_key, (select epoch_ms(updated_at) from known order by updated_at desc, id desc limit 1) as last_ms, (select id from known order by updated_at desc, id desc limit 1) as last_update_key from known")
def snapshot_cursor_argmax(spark, sf):
    """The cursors behind all rows of a snapshot."""
    known, _, _ = _states(spark, sf)
    c = cl.initial_cursor(known, "id", "updated_at")
    row = spark.createDataFrame([(c.last_key, c.last_time, c.last_update_key)], "last_key long, t timestamp_ntz, last_update_key long")
    return row.select("last_key", epoch_ms("t").alias("last_ms"), "last_update_key")


@query(_STATES + "select coalesce(c.id, k.id) as id, case when k.id is null then 'c' when c.id is null then 'd' else 'u' end as _op, k.status as old_status, c.status from known k full join current c on c.id = k.id where k.id is null or c.id is null or k.status is distinct from c.status")
def diff_snapshots(spark, sf):
    known, current, _ = _states(spark, sf)
    return cl.diff_snapshots(known, current, ["id"]).select("id", "_op", F.col("before.status").alias("old_status"), F.col("after.status").alias("status"))


# --- positions and records -------------------------------------------------------------------------------------------

_LSN = "printf('%X/%X', event_id % 4 * 1073741824, event_id * 7919)"


def _positions(spark, sf):
    return table(spark, sf, "events").select("event_id", F.format_string("%X/%X", F.col("event_id") % 4 * 1073741824, F.col("event_id") * 7919).alias("lsn"))


@query(f"select event_id, {_LSN} as lsn, cast((event_id % 4 * 1073741824)::hugeint * 4294967296 + event_id * 7919 as varchar) as n from events")
def lsn_numeric(spark, sf):
    return _positions(spark, sf).select("event_id", "lsn", lsn.lsn_number(F.col("lsn")).cast("string").alias("n"))


@query("select event_id from events where (event_id % 4 * 1073741824)::hugeint * 4294967296 + event_id * 7919 > (3::hugeint * 1073741824) * 4294967296 + 65536")
def lsn_newer_filter(spark, sf):
    return _positions(spark, sf).filter(lsn.lsn_newer(F.col("lsn"), F.lit("C0000000/10000"))).select("event_id")


@query(_WAL.replace("{events}", "events") + "select pos, type from wal")
def wal_classify(spark, sf):
    return wal_text(spark, sf).select("pos", records.record_kind(F.col("data")).alias("type"))


@query(_WAL.replace("{events}", "events") + "select pos, csn from wal where type = 'COMMIT'")
def wal_commit_csn(spark, sf):
    return wal_text(spark, sf).filter(F.col("data").startswith("COMMIT")).select("pos", records.commit_csn(F.col("data")).alias("csn"))


@query(_WAL.replace("{events}", "events") + "select pos, type, case when type in ('INSERT', 'UPDATE', 'DELETE') then 'public' end as schema_name, case when type in ('INSERT', 'UPDATE', 'DELETE') then 'events' end as table_name, case when type in ('UPDATE', 'DELETE') then cast(pk as varchar) end as old_id, case when type in ('INSERT', 'UPDATE') then kind end as new_kind from wal")
def wal_json_parse(spark, sf):
    found = records.parse_records(wal_text(spark, sf))
    return found.select("pos", "type", F.col("schema").alias("schema_name"), F.col("table").alias("table_name"), envelopes.value_of(F.col("before"), "id").alias("old_id"), envelopes.value_of(F.col("after"), "kind").alias("new_kind"))


@query("select doc_id, md5(text) as text_md5, length(text) as n_chars from documents")
def wal_json_columns_zip(spark, sf):
    """Whole texts, with their quotes, commas and brackets, through records and back; a null text is a null value."""
    docs = table(spark, sf, "documents")
    quoted = F.concat(F.lit("'"), F.replace("text", F.lit("'"), F.lit("''")), F.lit("'"))
    data = F.to_json(F.struct(F.lit("public.documents").alias("table_name"), F.lit("INSERT").alias("op_type"), F.array(F.lit("doc_id"), F.lit("text")).alias("columns_name"), F.array(F.lit("bigint"), F.lit("text")).alias("columns_type"), F.array(F.col("doc_id").cast("string"), quoted).alias("columns_val")))
    log = docs.select(F.lit("main").alias("slot"), F.col("doc_id").alias("pos"), F.lit("0/1").alias("lsn"), F.lit(1).cast("long").alias("xid"), data.alias("data"))
    after = records.parse_records(log).select(envelopes.value_of(F.col("after"), "doc_id").cast("long").alias("doc_id"), envelopes.value_of(F.col("after"), "text").alias("text"))
    return after.select("doc_id", F.md5("text").alias("text_md5"), F.char_length("text").cast("long").alias("n_chars"))


_OID_NAMES = ["integer", "INT4", "bigint", "smallint", "boolean", "real", "double precision", "numeric", "numeric(10,2)", "character varying", "char", "text", "timestamp", "timestamp with time zone", "date", "uuid"]
_OID_VALUES = [23, 23, 20, 21, 16, 700, 701, 1700, 25, 1043, 1042, 25, 1114, 1184, 1082, 25]


@query("select * from (values " + ", ".join(f"('{n}', {o})" for n, o in zip(_OID_NAMES, _OID_VALUES, strict=True)) + ") t(name, oid)")
def wal_type_oid(spark, sf):
    names = spark.range(1).select(F.explode(F.array(*map(F.lit, _OID_NAMES))).alias("name"))
    return names.select("name", kinds.type_oid(F.col("name")).alias("oid"))


@query("select o_orderkey as id, o_orderkey % 2 = 0 as flag, cast(cast(o_totalprice as decimal(12,2)) as varchar) as price, strftime(o_orderdate, '%Y-%m-%d') as day, epoch_ms(o_orderdate) as ms, cast(null as integer) as bad from orders")
def wal_cast_by_oid(spark, sf):
    o = table(spark, sf, "orders")
    text = o.select(F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, "t").otherwise("f").alias("flag"), F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("price"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), F.lit("12x").alias("bad"))
    cast = lambda c, oid, *a: kinds.cast_by_oid(F.col(c), oid, *a).alias(c)
    return text.select(cast("id", 20), cast("flag", 16), cast("price", 1700, 12, 2), cast("day", 1082), cast("ts", 1114), cast("bad", 23)).select("id", "flag", F.col("price").cast("string").alias("price"), F.col("day").cast("string").alias("day"), epoch_ms("ts").alias("ms"), "bad")


_TABLES = ["orders", "ORDERS_2024", "lineitem", "order.items", "archive_orders"]


def _names(spark, sf):
    names = F.array(*map(F.lit, _TABLES))
    return table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, "Public").otherwise("other").alias("s"), names[(F.col("event_id") % len(_TABLES)).cast("int")].alias("t"))


_NAMES_SQL = "with n as (select event_id, case when event_id % 3 = 0 then 'Public' else 'other' end s, ([" + ", ".join(f"'{t}'" for t in _TABLES) + f"])[event_id % {len(_TABLES)} + 1] t from events) "


@query(_NAMES_SQL + "select event_id, t from n where lower(s) = 'public' and regexp_full_match(lower(t), 'orders.*')")
def table_match_regex(spark, sf):
    return _names(spark, sf).filter(naming.table_matches(F.col("s"), F.col("t"), "public", "orders.*")).select("event_id", "t")


@query(_NAMES_SQL + "select event_id, t from n where lower(s) = 'public' and lower(t) = 'orders_2024'")
def table_match_exact(spark, sf):
    return _names(spark, sf).filter(naming.table_matches(F.col("s"), F.col("t"), "PUBLIC", "orders_2024")).select("event_id", "t")


@query("select event_id, 'public' as schema_name, 'events' as table_name, ['INSERT', 'UPDATE', 'DELETE'][event_id % 3 + 1] as type from events")
def wal_text_parse(spark, sf):
    op = F.array(*map(F.lit, tx.DATA))[(F.col("event_id") % 3).cast("int")]
    data = F.concat(op, F.lit(": public.events [id[integer]:"), F.col("event_id"), F.lit("]"))
    log = table(spark, sf, "events").select(F.lit("main").alias("slot"), F.col("event_id").alias("pos"), F.lit("0/1").alias("lsn"), F.lit(1).cast("long").alias("xid"), data.alias("data"))
    return records.parse_records(log).select(F.col("pos").alias("event_id"), F.col("schema").alias("schema_name"), F.col("table").alias("table_name"), "type")


@query("select event_id as pos, k, event_type as kind from events, (values (0), (1)) v(k)")
def json_batch_split(spark, sf):
    one = F.to_json(F.struct(F.lit("public.e}{").alias("table_name"), F.col("event_type").alias("op_type")))
    log = table(spark, sf, "events").select(F.lit("main").alias("slot"), F.col("event_id").alias("pos"), F.concat(F.lit("["), one, F.lit(", "), one, F.lit("] {\"open\": ")).alias("data"))
    return records.split_batches(log).select("pos", "k", F.get_json_object("data", "$.op_type").alias("kind"))


@query("select event_id // 1500 as pos, cast(event_id % 1500 as integer) as k, user_id as id from events")
def json_batch_large(spark, sf):
    """Batches of 1500 records each, through the splitter and the parser."""
    fields = lambda *v: F.array(*v)
    one = F.to_json(F.struct(F.lit("public.events").alias("table_name"), F.lit("INSERT").alias("op_type"), fields(F.lit("id")).alias("columns_name"), fields(F.lit("bigint")).alias("columns_type"), fields(F.col("user_id").cast("string")).alias("columns_val")))
    rows = table(spark, sf, "events").select(F.floor(F.col("event_id") / 1500).alias("pos"), F.struct("event_id", one.alias("one")).alias("r"))
    log = rows.groupBy("pos").agg(F.array_join(F.array_sort(F.collect_list("r"))["one"], "\n").alias("data"))  # 1500 rows each
    log = log.select(F.lit("main").alias("slot"), "pos", F.lit("0/1").alias("lsn"), F.lit(1).cast("long").alias("xid"), "data")
    found = records.parse_records(records.split_batches(log))
    return found.select("pos", "k", envelopes.value_of(F.col("after"), "id").cast("long").alias("id"))

def _encoded(spark: SparkSession, sf: str, make: Callable[[int, int, str], list[binary.WalChange]], start: int = 0) -> DataFrame:
    """Events as binary batches (slot, pos, data), one for each."""
    import pyarrow as pa

    def encode(batches):
        for batch in batches:
            out = [binary.encode_batch(make(*row), separator_inside=row[0] % 2 == 0) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            places = pa.array([event + start for event in batch.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(["main"] * len(out), pa.string()), places, pa.array(out, pa.binary())], names=["slot", "pos", "data"])

    return table(spark, sf, "events").select("event_id", "user_id", "event_type").mapInArrow(encode, "slot string, pos long, data binary")


def _one_insert(event: int, user: int, kind: str) -> list[binary.WalChange]:
    image = [("event_id", 20, str(event)), ("user_id", 20, str(user)), ("event_type", 1043, kind)]
    insert = binary.WalChange("INSERT", event * 8 + 1, schema="public", table="events", after=image)
    return [binary.WalChange("BEGIN", event * 8, csn=event + 1), insert, binary.WalChange("COMMIT", event * 8 + 2, xid=event)]


@_once
def binary_log(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as a batch of one transaction."""
    return _encoded(spark, sf, _one_insert)


@_once
def binary_log_over_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions of eight events over eight batches, at places beyond ten million million; the first event begins one and
    the last commits it. Every third event is an update with its old image, every fifth a delete."""

    def make(event: int, user: int, kind: str) -> list[binary.WalChange]:
        image, key = [("event_id", 20, str(event)), ("user_id", 20, str(user)), ("event_type", 1043, kind)], [("event_id", 20, str(event))]
        op = "DELETE" if event % 5 == 0 else "UPDATE" if event % 3 == 0 else "INSERT"
        change = binary.WalChange(op, event * 8 + 1, schema="public", table="events", before=None if op == "INSERT" else key, after=None if op == "DELETE" else image)
        begin = [binary.WalChange("BEGIN", event * 8, csn=event // 8 + 1)] if event % 8 == 0 else []
        return [*begin, change, *([binary.WalChange("COMMIT", event * 8 + 2, xid=event // 8)] if event % 8 == 7 else [])]

    return _encoded(spark, sf, make, 10_000_000_000_000)


@query("select event_id, user_id, event_type, event_id + 1 as csn from events")
def binary_decode(spark, sf):
    """Binary batches of a transaction each, decoded and released."""
    found = tx.committed_prefix(binary.number_transactions(binary.decode_binary(binary_log(spark, sf))))
    value = lambda n: envelopes.value_of(F.col("after"), n)
    return found.select(value("event_id").cast("long").alias("event_id"), value("user_id").cast("long").alias("user_id"), value("event_type").alias("event_type"), F.col("commit_csn").alias("csn"))


_OVER = "with m as (select *, (select max(event_id) from events) most from events), o as (select *, event_id // 8 blk, case when event_id % 5 = 0 then 'DELETE' when event_id % 3 = 0 then 'UPDATE' else 'INSERT' end op from m) "
_WHOLE = " where blk * 8 + 7 <= most"


@query(_OVER + "select event_id, op as type, case when op <> 'DELETE' then event_type end as event_type, case when op <> 'INSERT' then event_id end as old_id, blk + 1 as csn from o" + _WHOLE)
def binary_update_delete(spark, sf):
    """Inserts, updates with old images and deletes of transactions that lie over many batches; the last one stays open."""
    found = tx.committed_prefix(binary.number_transactions(binary.decode_binary(binary_log_over_batches(spark, sf))))
    new, old = (envelopes.value_of(F.col(c), "event_id").cast("long") for c in ("after", "before"))
    return found.select(F.coalesce(new, old).alias("event_id"), "type", envelopes.value_of(F.col("after"), "event_type").alias("event_type"), old.alias("old_id"), F.col("commit_csn").alias("csn"))


@query(_OVER + "select 10000000000000 + event_id as pos, case when event_id % 8 = 0 then 1 else 0 end as k, 10000000000000 + blk * 8 as txn_pos from o" + _WHOLE)
def binary_large_position(spark, sf):
    """Places beyond ten million million, and the place at which each record's transaction began."""
    found = tx.committed_prefix(binary.number_transactions(binary.decode_binary(binary_log_over_batches(spark, sf))))
    return found.select("pos", "k", F.col("txn.pos").alias("txn_pos"))


# --- transactions ----------------------------------------------------------------------------------------------------


@query(_PREFIX + "select t.bp as txn, t.xid, cp as commit_pos, coalesce(n, 0) as n_changes from t left join (select xid, count(*) n from d group by xid) using (xid)")
def txn_reassemble(spark, sf):
    return tx.transactions(wal(spark, sf)).select("txn", "xid", "commit_pos", "n_changes")


@query(_PREFIX + "select bp as txn, pos, xid, type, cc as commit_csn from p")
def txn_committed_prefix(spark, sf):
    return tx.committed_prefix(wal(spark, sf)).select("txn", "pos", "xid", "type", "commit_csn")


@query(_PREFIX + f"select bp as txn, pos, cc as commit_csn from p where not (cc > 0 and cc <= {SNAPSHOT_CSN})")
def txn_snapshot_overlap(spark, sf):
    return committed(spark, sf).select("txn", "pos", "commit_csn")


@query(_PREFIX + "select bp as txn, pos, xid from p where cp > 1600")
def txn_replay_filter(spark, sf):
    return tx.committed_prefix(wal(spark, sf), last_lsn="0/640").select("txn", "pos", "xid")


@query(_PREFIX + "select 'main' as slot, printf('%X/%X', max(cp) // 4294967296, max(cp) % 4294967296) as lsn from done")
def txn_watermark(spark, sf):
    return tx.watermark(wal(spark, sf))


@query(_WAL.replace("{events}", "events") + "select pos, xid from wal where pos > 4096")
def unacknowledged_records(spark, sf):
    return tx.unacknowledged(wal(spark, sf), "0/1000").select("pos", "xid")


# --- rows and tables -------------------------------------------------------------------------------------------------


@query(_PREFIX + f"select pos, pk as id, case when type = 'DELETE' then null else kind end as kind, cast(null as date) as note from p where cc > {SNAPSHOT_CSN}")
def wal_pad_columns(spark, sf):
    schema = T.StructType().add("id", "long").add("kind", "string").add("note", "date")
    return cl.typed_rows(committed(spark, sf), schema, "drop", ["pos"]).drop("_op")


@query(_PREFIX + f"select pos, case type when 'INSERT' then 'c' when 'UPDATE' then 'u' else 'd' end as _op, pk as id from p where cc > {SNAPSHOT_CSN}")
def wal_rowkind(spark, sf):
    return cl.typed_rows(committed(spark, sf), T.StructType().add("id", "long"), "drop", ["pos"])


@query("select event_id, case when event_id % 3 = 0 then null else event_id end as id, event_id % 3 = 0 as failed from events")
def wal_dead_letters(spark, sf):
    text = F.when(F.col("event_id") % 3 == 0, "n/a").otherwise(F.col("event_id").cast("string"))
    after = F.array(F.struct(F.lit("id").alias("name"), F.lit(20).alias("type_oid"), text.alias("value")))
    rows = table(spark, sf, "events").select("event_id", F.lit("INSERT").alias("type"), F.lit(None).cast(f"array<{records.COLUMN}>").alias("before"), after.alias("after"))
    return cl.typed_rows(rows, T.StructType().add("id", "long"), keep=["event_id"]).select("event_id", "id", (F.size("_error") > 0).alias("failed"))


_LATEST = _PREFIX + f", l as (select *, row_number() over (partition by pk order by bp desc, pos desc) place from p where cc > {SNAPSHOT_CSN}) "


def _changes(spark, sf):
    rows = cl.typed_rows(committed(spark, sf), T.StructType().add("id", "long").add("kind", "string"), "drop", ["txn", "pos"])
    return rows.withColumnRenamed("txn", "_txn").withColumnRenamed("pos", "_pos")


@query(_LATEST + "select pk as id, kind from l where place = 1 and type <> 'DELETE'")
def materialize_latest(spark, sf):
    return cl.materialise(_changes(spark, sf), ["id"], ["_txn", "_pos"])


@query(_LATEST + ", base as (select distinct user_id id, 'base' kind from events) select id, kind from base where id not in (select pk from l) union all select pk, kind from l where place = 1 and type <> 'DELETE'")
def apply_changes_to_snapshot(spark, sf):
    base = table(spark, sf, "events").select(F.col("user_id").alias("id"), F.lit("base").alias("kind")).distinct()
    return cl.apply_changes(base, _changes(spark, sf), ["id"], ["_txn", "_pos"])


@query(_PREFIX + f"select case type when 'INSERT' then 'c' when 'UPDATE' then 'u' else 'd' end as _op, count(*) as n, count(distinct pk) as keys from p where cc > {SNAPSHOT_CSN} group by 1")
def change_counts_by_op(spark, sf):
    return _changes(spark, sf).groupBy("_op").agg(F.count("*").alias("n"), F.countDistinct("id").alias("keys"))


def _customers(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    new = c.filter("c_custkey % 3 = 0").select((F.col("c_custkey") + F.when(F.col("c_custkey") % 2 == 0, 1_000_000).otherwise(0)).alias("c_custkey"), F.lower("c_name").alias("c_name"), F.when(F.col("c_custkey") % 9 != 0, "NEW").alias("c_mktsegment"))
    return c, new


_NEW = "new as (select c_custkey + case when c_custkey % 2 = 0 then 1000000 else 0 end c_custkey, lower(c_name) c_name, case when c_custkey % 9 <> 0 then 'NEW' end c_mktsegment from customer where c_custkey % 3 = 0)"


@query(f"with {_NEW} select c_custkey, c_name, c_mktsegment from customer where c_custkey not in (select c_custkey from new) union all select * from new")
def upsert_merge(spark, sf):
    return cl.upsert(*_customers(spark, sf), ["c_custkey"])


@query(f"with {_NEW} select coalesce(n.c_custkey, c.c_custkey) as c_custkey, coalesce(n.c_name, c.c_name) as c_name, coalesce(n.c_mktsegment, c.c_mktsegment) as c_mktsegment from customer c full join new n on n.c_custkey = c.c_custkey")
def upsert_ignore_null(spark, sf):
    return cl.upsert(*_customers(spark, sf), ["c_custkey"], ignore_null=True)


@query(f"with {_NEW} select c_custkey, c_name, c_mktsegment from customer where c_custkey not in (select c_custkey from new)")
def delete_by_key(spark, sf):
    return cl.delete_by_key(*_customers(spark, sf), ["c_custkey"])


# --- events as JSON --------------------------------------------------------------------------------------------------

_NEW_JSON = """'{"id":"' || pk || '","kind":"' || kind || '"}'"""
_OLD_JSON = """'{"id":"' || pk || '"}'"""
_IMAGES = _PREFIX + f""", v as (select pos, type, pk, substr(type, 1, 1) letter, case when type = 'DELETE' then 'null' else {_NEW_JSON} end newj, case when type = 'INSERT' then 'null' else {_OLD_JSON} end oldj, printf('%X/%X', pos // 4294967296, pos % 4294967296) place from p where cc > {SNAPSHOT_CSN}) """


def _events(spark, sf):
    rows = committed(spark, sf)
    op = F.when(F.col("type") == "INSERT", "c").when(F.col("type") == "UPDATE", "u").otherwise("d")
    return rows.withColumn("op", op)


@query(_IMAGES + """select pos, '{"before":' || oldj || ',"after":' || newj || ',"source":{"connector":"tidewire","db":"db","schema":"public","table":"events","lsn":"' || place || '","ts_ms":' || pos || ',"snapshot":false},"op":"' || case letter when 'I' then 'c' when 'U' then 'u' else 'd' end || '","ts_ms":' || pos || ',"transaction":null}' as event from v""")
def env_debezium(spark, sf):
    e = envelopes.debezium(F.col("op"), F.col("before"), F.col("after"), "db", F.col("schema"), F.col("table"), F.col("pos"), F.col("lsn"))
    return _events(spark, sf).select("pos", e.alias("event"))


@query(_IMAGES + """select pos, '{"data":' || newj || ',"old":' || oldj || ',"database":"db","table":"events","type":"' || type || '","pkNames":["id"],"es":' || pos || ',"ts":' || pos || ',"isDdl":false,"sqlType":{},"mysqlType":{}}' as event from v""")
def env_canal(spark, sf):
    e = envelopes.canal(F.col("op"), F.col("before"), F.col("after"), "db", F.col("table"), ["id"], F.col("pos"))
    return _events(spark, sf).select("pos", e.alias("event"))


@query(_IMAGES + """select pos, '{"database":"db","table":"events","optType":"' || type || '","pkNames":["id"],"pkValues":["' || pk || '"],"es":' || pos || ',"ts":' || pos || ',"data":' || newj || ',"old":' || oldj || ',"lsn":"' || place || '"}' as event from v""")
def env_he(spark, sf):
    e = envelopes.he(F.col("op"), F.col("before"), F.col("after"), "db", F.col("table"), ["id"], F.col("pos"), F.col("lsn"))
    return _events(spark, sf).select("pos", e.alias("event"))


@query(_PREFIX + f"select pos, cast(pk as varchar) as id from p where cc > {SNAPSHOT_CSN}")
def he_pk_values(spark, sf):
    return _events(spark, sf).select("pos", envelopes.key_values(F.col("op"), F.col("before"), F.col("after"), ["id"])[0].alias("id"))


@query(r"""select event_id, replace(replace(props, '\', '\\'), '"', '\"') || '\n\t\u0001' as escaped from events""")
def json_escape(spark, sf):
    return table(spark, sf, "events").select("event_id", envelopes.json_escape(F.concat("props", F.lit("\n\t\x01"))).alias("escaped"))


# --- SQL text, names, catalog ----------------------------------------------------------------------------------------


def _one(spark: SparkSession, **values: str | int) -> DataFrame:
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))


def _literal(**values: str) -> str:
    return "select " + ", ".join(f"'{v.replace(chr(39), chr(39) * 2)}' as {k}" for k, v in values.items())


@query(_literal(upsert="INSERT INTO t(id, name, age) VALUES (:id, :name, :age) ON DUPLICATE KEY UPDATE name=VALUES(name), age=VALUES(age)", keys_only="INSERT INTO t(id) VALUES (:id) ON DUPLICATE KEY UPDATE NOTHING"))
def sql_upsert_text(spark, sf):
    d = POSTGRES_FAMILY
    return _one(spark, upsert=d.upsert("t", ["id", "name", "age"], ["id"]), keys_only=d.upsert("t", ["id"], ["id"]))


@query(_literal(del_="DELETE FROM t WHERE id = :id AND k = :k", ins="INSERT INTO t(id, k) VALUES (:id, :k)", sel="SELECT id, v FROM t WHERE id = :id", lim="LIMIT 5"))
def sql_delete_text(spark, sf):
    d = POSTGRES_FAMILY
    return _one(spark, del_=d.delete("t", ["id", "k"]), ins=d.insert("t", ["id", "k"]), sel=d.select("t", ["id", "v"], ["id"]), lim=d.limit_clause(5))


@query(_literal(plain="order", quoted='"a""b"', path='"s"."t"', cols="`a`, `b`"))
def quote_identifier(spark, sf):
    return _one(spark, plain=Dialect().quote_identifier("order"), quoted=naming.quote('a"b'), path=naming.qualified("s", "t"), cols=naming.column_list(["a", "b"], naming.quote_mark("M", None)))


@query("select * from (values ('t', 'public', 't'), ('s.t', 's', 't'), ('a.b.c', null, null), ('.t', null, null)) v(path, schema_name, table_name)")
def table_path_parse(spark, sf):
    paths = spark.range(1).select(F.explode(F.array(*map(F.lit, ["t", "s.t", "a.b.c", ".t"]))).alias("path"))
    found = paths.select("path", naming.parse_path(F.col("path")).alias("p"))
    return found.select("path", F.col("p.schema").alias("schema_name"), F.col("p.table").alias("table_name"))


_MAPPED = [("bool", 0, 0, "boolean"), ("bytea", 0, 0, "binary"), ("int2", 0, 0, "smallint"), ("serial", 0, 0, "int"), ("int8", 0, 0, "bigint"), ("float4", 0, 0, "float"), ("float8", 0, 0, "double"), ("numeric", 10, 5, "decimal(10,5)"), ("numeric", 0, 0, "decimal(38,18)"), ("bpchar", 3, 0, "char(3)"), ("varchar", 20, 0, "varchar(20)"), ("text", 0, 0, "string"), ("timestamp", 0, 5, "timestamp_ntz"), ("timestamptz", 0, 6, "timestamp"), ("time", 0, 0, "string"), ("date", 0, 0, "date"), ("_int4", 0, 0, "array<int>"), ("_numeric", 10, 2, "array<decimal(10,2)>")]


@query("select * from (values " + ", ".join(f"('{n}', {p}, {s}, '{t}')" for n, p, s, t in _MAPPED) + ") v(name, p, s, spark_type)")
def type_map(spark, sf):
    rows = [F.struct(F.lit(n).alias("name"), F.lit(p).alias("p"), F.lit(s).alias("s"), F.lit(kinds.map_type(n, p, s, True).simpleString()).alias("spark_type")) for n, p, s, _ in _MAPPED]
    return spark.range(1).select(F.inline(F.array(*rows)))


_META = [("public", "orders", "BASE TABLE"), ("public", "v_orders", "VIEW"), ("sales", "items", "BASE TABLE"), ("pg_catalog", "pg_class", "BASE TABLE"), ("information_schema", "tables", "BASE TABLE")]


def _meta(spark):
    return spark.createDataFrame(_META, "table_schema string, table_name string, table_type string")


@query("select * from (values ('public.orders'), ('sales.items')) v(name)")
def catalog_list_tables(spark, sf):
    return catalog.tables_of(_meta(spark))


@query("select n_name as datname from nation")
def catalog_builtin_filter(spark, sf):
    names = table(spark, sf, "nation").select(F.col("n_name").alias("datname"))
    return catalog.databases_of(names.unionByName(spark.createDataFrame([("template0",), ("template1",)], "datname string")))


@query("select * from (values ('orders', 'o_orderkey', true), ('lineitem', 'l_orderkey,l_linenumber', false), ('log', '', false)) v(name, key_columns, capturable)")
def pk_single_column_check(spark, sf):
    keys = spark.createDataFrame([("orders", "o_orderkey", 1), ("lineitem", "l_orderkey", 1), ("lineitem", "l_linenumber", 2)], "name string, column_name string, place int")
    names = spark.createDataFrame([("orders",), ("lineitem",), ("log",)], "name string")
    return catalog.key_columns(names, keys)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The current state of ``events`` from its log."""
    return materialize_latest(spark, sf)
