"""Invoice status lookup (JOIN6, JOIN7, SET2/AGG3).

Header and detail tables are both large. When only some transactions need a
status, the detail rows are first reduced to those transaction ids
(``reduced_details``, with a measured ``KeySet``); the caller materialises and
measures that result, whose invoice numbers then reduce the headers the same
way. Beyond the bounds every step is a shuffle join. The result equals the
full lookup restricted to the wanted ids, which is all a left join by
transaction id can use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.operators.broadcast import KeySet, maybe_broadcast
from gatewatch.sources.tables import TollTables

INVOICE_COLUMNS = ("status", "create_channel", "transaction_id")
SIDES = ("member", "nonmember")


def _pairs(tables: TollTables):
    return (
        ("member", tables.member_invoice, tables.member_invoice_detail),
        ("nonmember", tables.nonmember_invoice, tables.nonmember_invoice_detail),
    )


def _detail(detail: DataFrame) -> DataFrame:
    return detail.select(F.col("invoice_no").alias("_inv"), "create_channel", "transaction_id")


def _join(header: DataFrame, detail: DataFrame, detail_small: bool) -> DataFrame:
    h = header.select(F.col("invoice_no").alias("_hinv"), "status")
    d = maybe_broadcast(detail, detail_small)
    return h.join(d, h["_hinv"] == d["_inv"], "inner").select(*INVOICE_COLUMNS)


def invoice_union_distinct(tables: TollTables) -> DataFrame:
    """Distinct (status, create_channel, transaction_id) over the member and
    non-member invoice joins, whole tables (JOIN6 + SET2 + AGG3). Rows from
    both sides merge."""
    out = None
    for _, header, detail in _pairs(tables):
        pair = _join(header, _detail(detail), False)
        out = pair if out is None else out.unionByName(pair)
    return out.distinct()


def reduced_details(tables: TollTables, ids: KeySet) -> DataFrame:
    """Detail rows of both invoice kinds whose transaction id is in ``ids``,
    tagged with their side (``_side``)."""
    out = None
    for side, _, detail in _pairs(tables):
        d = ids.restrict(_detail(detail), "transaction_id").withColumn("_side", F.lit(side))
        out = d if out is None else out.unionByName(d)
    return out


def invoices_for_details(tables: TollTables, details: DataFrame, invoice_nos: KeySet) -> DataFrame:
    """The distinct invoice rows of ``reduced_details``; ``invoice_nos`` is the
    measured key set of its ``_inv`` column, which reduces each header table."""
    out = None
    for side, header, _ in _pairs(tables):
        d = details.where(F.col("_side") == side).drop("_side")
        pair = _join(invoice_nos.restrict(header, "invoice_no"), d, invoice_nos.small)
        out = pair if out is None else out.unionByName(pair)
    return out.distinct()


def invoice_status_left_join(df: DataFrame, invoices: DataFrame) -> DataFrame:
    """Left join status and channel by transaction id (JOIN7); several
    invoices fan the row out."""
    y = invoices.select(F.col("transaction_id").alias("_inv_tid"), "status", "create_channel")
    return df.join(y, df["transaction_id"] == y["_inv_tid"], "left").drop("_inv_tid")
