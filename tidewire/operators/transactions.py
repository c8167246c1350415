"""Transactions of a log: which changes are committed, in which order they come out, and up to where the log is done.

Input is the changes of ``functions.records`` (slot, pos, lsn, xid, csn, type, ...). A transaction is opened by its
BEGIN and closed by the COMMIT of its xid; an xid may be used again after that. Transactions come out in the order
of their BEGINs, and one that is still open holds back all that began after it. A data record whose xid has
no open transaction is a committed transaction of its own.

The order of a log is that of ``pos``, or of (pos, k) where records have a place ``k`` within a batch; ``txn`` is such a place.

Windows go over BEGIN and COMMIT rows alone: they give a span for each transaction, a narrow table that is written
once. Data rows find their span by slot, xid and place, in a join between a written table and the log, so a bulk
load in one transaction can be split over tasks. What is released needs no order at all: all that began before the first
transaction of its slot that is open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lsn import lsn_number
from ..plans.stage import join_small, written

DATA = ("INSERT", "UPDATE", "DELETE")


def is_data(type_: str = "type") -> Column:
    return F.col(type_).isin(*DATA)


def place(changes: DataFrame) -> Column:
    """Where a record stands in its slot's log."""
    return F.struct("pos", "k") if "k" in changes.columns else F.col("pos")


def spans(changes: DataFrame) -> DataFrame:
    """(slot, xid, txn, commit_pos, commit_lsn, commit_csn): a row for each transaction with a BEGIN; null commits are open.

    Within (slot, xid) a BEGIN opens a transaction unless one is open; the next COMMIT closes it.
    """
    by_xid = Window.partitionBy("slot", "xid").orderBy("at")
    markers = changes.filter(F.col("type").isin("BEGIN", "COMMIT")).select("slot", "xid", place(changes).alias("at"), "type", "lsn", "csn")
    turns = markers.withColumn("_last", F.lag("type", 1, "COMMIT").over(by_xid)).filter("type <> _last")
    ended = F.lead(F.struct("at", "lsn", "csn")).over(by_xid)
    found = turns.withColumn("_end", ended).filter("type = 'BEGIN'")
    return found.select("slot", "xid", F.col("at").alias("txn"), *(F.col(f"_end.{a}").alias(b) for a, b in (("at", "commit_pos"), ("lsn", "commit_lsn"), ("csn", "commit_csn"))))


def _placed(changes: DataFrame, found: DataFrame) -> DataFrame:
    """Data records with the span of their transaction, or with one of their own."""
    data = changes.filter(is_data()).withColumn("_at", place(changes))
    found = found.withColumnRenamed("xid", "_xid").withColumnRenamed("slot", "_slot")
    within = (data["slot"] == found["_slot"]) & data["xid"].eqNullSafe(found["_xid"]) & (data["_at"] > found["txn"]) & (found["commit_pos"].isNull() | (data["_at"] < found["commit_pos"]))
    rows = data.join(found, within, "left")
    own = F.col("txn").isNull()
    return rows.select(
        *changes.columns, F.coalesce("txn", "_at").alias("txn"), F.when(own, F.col("_at")).otherwise(F.col("commit_pos")).alias("commit_pos"),
        F.when(own, F.col("lsn")).otherwise(F.col("commit_lsn")).alias("commit_lsn"), F.when(own, F.lit(0).cast("long")).otherwise(F.col("commit_csn")).alias("commit_csn"), own.alias("own"),
    )


def transactions(changes: DataFrame) -> DataFrame:
    """(slot, txn, xid, commit_pos, commit_lsn, commit_csn, n_changes): a row for each transaction; null commits are open."""
    found = written(spans(changes), "spans")
    placed = _placed(changes, found)
    counts = placed.filter("not own").groupBy("slot", "txn").agg(F.count("*").alias("n_changes"))
    closed = ["commit_pos", "commit_lsn", "commit_csn"]
    out = found.join(counts, ["slot", "txn"], "left").select("slot", "txn", "xid", *closed, F.coalesce("n_changes", F.lit(0)).alias("n_changes"))
    return out.unionByName(placed.filter("own").select("slot", "txn", "xid", *closed, F.lit(1).cast("long").alias("n_changes")))


def released(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The ``rows`` (slot, txn) that no open transaction of ``found`` holds back."""
    first = written(found.filter("commit_pos is null").groupBy("slot").agg(F.min("txn").alias("_open")), "open-transactions")
    return join_small(rows, first, ["slot"]).filter(F.col("_open").isNull() | (F.col("txn") < F.col("_open"))).drop("_open")


def overlaps_snapshot(csn: Column, snapshot_csn: int) -> Column:
    """Whether a snapshot taken at ``snapshot_csn`` holds the transaction already; a negative number is no snapshot."""
    return F.lit(snapshot_csn >= 0) & (csn > 0) & (csn <= snapshot_csn)


def replayed(commit_lsn: Column, last_lsn: str | None) -> Column:
    """Whether a transaction was committed at or before the last position that was consumed. Positions of data records do
    not count: a transaction may have begun before that and ended after it."""
    if last_lsn is None:
        return F.lit(False)
    return F.coalesce(lsn_number(commit_lsn) <= lsn_number(F.lit(last_lsn)), F.lit(False))


def committed_prefix(changes: DataFrame, snapshot_csn: int = -1, last_lsn: str | None = None) -> DataFrame:
    """The data records of all released transactions that neither the snapshot nor an earlier run has, with ``txn``,
    ``commit_lsn`` and ``commit_csn``. Their order is (slot, txn, pos)."""
    found = written(spans(changes), "spans")
    done = released(_placed(changes, found).filter("commit_pos is not null"), found)
    done = done.filter(~overlaps_snapshot(F.col("commit_csn"), snapshot_csn) & ~replayed(F.col("commit_lsn"), last_lsn))
    return done.drop("commit_pos", "own")


def watermark(changes: DataFrame, last_lsn: str | None = None) -> DataFrame:
    """(slot, lsn): up to where each slot is done, the largest commit position of its released transactions, of dropped
    ones too; it never goes back behind ``last_lsn``. A COMMIT without a transaction counts if nothing that began before
    it was open at that place."""
    found = written(spans(changes), "spans")
    lone = _placed(changes, found).filter("own").select("slot", "txn", "commit_lsn")
    closed = found.select("slot", F.col("txn").alias("at"), F.col("commit_pos").alias("until"), F.col("commit_pos").isNull().alias("open"), F.lit(None).cast("string").alias("lsn"))
    by_xid = Window.partitionBy("slot", "xid").orderBy("at")
    markers = changes.filter(F.col("type").isin("BEGIN", "COMMIT")).select("slot", "xid", place(changes).alias("at"), "type", "lsn")
    stray = markers.withColumn("_last", F.lag("type", 1, "COMMIT").over(by_xid)).filter("type = 'COMMIT' and _last = 'COMMIT'")
    stray = stray.select("slot", "at", F.lit(None).cast(closed.schema["until"].dataType).alias("until"), F.lit(False).alias("open"), "lsn")
    upto = Window.partitionBy("slot").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)  # BEGINs and stray COMMITs alone
    seen = closed.unionByName(stray).withColumn("_until", F.max("until").over(upto)).withColumn("_open", F.max("open").over(upto))
    clear = seen.filter("lsn is not null and not _open").filter(F.col("_until").isNull() | (F.col("_until") < F.col("at")))
    ended = released(found.filter("commit_pos is not null").select("slot", "txn", "commit_lsn").unionByName(lone), found)
    all_ = ended.select("slot", F.col("commit_lsn").alias("lsn")).unionByName(clear.select("slot", "lsn"))
    number = lsn_number(F.col("lsn"))
    best = all_.groupBy("slot").agg(F.max(number).alias("n"), F.max_by("lsn", number).alias("lsn"))
    if last_lsn is None:
        return best.select("slot", "lsn")
    return best.select("slot", F.when(F.col("n") > lsn_number(F.lit(last_lsn)), F.col("lsn")).otherwise(F.lit(last_lsn)).alias("lsn"))


def unacknowledged(changes: DataFrame, acknowledged: str | None) -> DataFrame:
    """Records behind the acknowledged position: what a peek reads again."""
    if acknowledged is None:
        return changes
    return changes.filter(lsn_number(F.col("lsn")) > lsn_number(F.lit(acknowledged)))


def newer_changes(changes: DataFrame, last_lsn: str | None) -> DataFrame:
    """Records behind the last position consumed: the filter of a log that comes without transaction markers."""
    return unacknowledged(changes, last_lsn)
