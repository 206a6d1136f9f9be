"""Tables of a database, read in parallel by lists of predicates (SRC1).

Spark's numeric range read needs a numeric column whose MIN and MAX say
something: a string key has none, and one back-dated id stretches the range so
that nearly all rows fall into one query. Here a large table is read by hash
predicates instead: the database hashes the key into ``n`` buckets, and each
bucket is one query, whatever the key's type and spread. Rows without a key
belong to bucket 0. A gate table with a window is read by ``n`` slices of the
window, so each query is bounded at both ends.

Only the fixed dimension tables (provinces, list types) are read in one query.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.sources.tables import CAMERA_TABLES, GATE_TABLES, OTHER_TABLES, GateScan, TollTables, Window


@dataclass(frozen=True)
class Dialect:
    """How a database spells a hash of {c} into {n} buckets (0 to {last}), and
    a timestamp {t}."""

    hash_sql: str
    timestamp_sql: str = "TIMESTAMP '{t}'"

    def hash_predicates(self, column: str, n: int) -> list[str]:
        """``n`` predicates of which every row satisfies exactly one."""
        if n < 2:
            return ["1 = 1"]
        bucket = self.hash_sql.format(c=column, n=n, last=n - 1)
        rest = [f"({column} IS NOT NULL AND {bucket} = {k})" for k in range(1, n)]
        return [f"({column} IS NULL OR {bucket} = 0)", *rest]

    def window_predicates(self, column: str, window: Window, n: int) -> list[str]:
        """At most ``n`` predicates of which every row of the window satisfies
        exactly one, and no other row any. Slices are whole seconds, so a short
        window has fewer."""
        seconds = int((window.hi - window.lo).total_seconds())
        n = max(1, min(n, seconds))
        at = [window.lo + timedelta(seconds=seconds * k // n) for k in range(n)]
        lit = lambda t: self.timestamp_sql.format(t=t.strftime("%Y-%m-%d %H:%M:%S"))
        inner = [f"({column} >= {lit(a)} AND {column} < {lit(b)})" for a, b in zip(at, at[1:])]
        return [*inner, f"({column} >= {lit(at[-1])} AND {column} <= {lit(window.hi)})"]


# The hash functions of the databases, by the name in their URL.
DIALECTS = {
    "oracle": Dialect("ORA_HASH({c}, {last})"),
    "postgresql": Dialect("MOD(HASHTEXT(CAST({c} AS TEXT)) & 2147483647, {n})"),
    "mysql": Dialect("MOD(CRC32({c}), {n})"),
    "mariadb": Dialect("MOD(CRC32({c}), {n})"),
    "sqlserver": Dialect("((CHECKSUM({c}) & 2147483647) % {n})", "'{t}'"),
    "hive2": Dialect("PMOD(HASH({c}), {n})"),
}

# The key by whose hash each large table is dealt into queries.
SPLIT_COLUMNS = {
    **{name: "TRANSACTION_ID" for name in (*GATE_TABLES.values(), *CAMERA_TABLES.values())},
    "back_camera": "REF_TRANSACTION_ID",
    "invoice_rollback": "PLATE2",
    "member_invoice": "INVOICE_NO",
    "nonmember_invoice": "INVOICE_NO",
    "member_invoice_detail": "INVOICE_NO",
    "nonmember_invoice_detail": "INVOICE_NO",
    "watchlist_master": "PLATE2",
}
# Fixed dimensions, one query each.
SMALL_TABLES = ("province_office", "watchlist_type")

# (database table, predicates or None for the whole table) -> rows
Reader = Callable[[str, "list[str] | None"], DataFrame]


def dialect_of(url: str, hash_sql: str | None = None) -> Dialect:
    """The dialect of a ``jdbc:NAME:...`` URL; ``hash_sql`` replaces its hash,
    and is needed for a database that is not listed."""
    name = url.split(":")[1] if url.startswith("jdbc:") and url.count(":") > 1 else ""
    known = DIALECTS.get(name)
    if hash_sql:
        return Dialect(hash_sql, known.timestamp_sql if known else Dialect.timestamp_sql)
    if known is None:
        raise ValueError(f"no hash function is known for {name or url!r}: give hash_sql, with {{c}} and {{n}}")
    return known


def jdbc_reader(spark: SparkSession, url: str, properties: Mapping[str, str]) -> Reader:
    # A database DATE or TIMESTAMP without a zone is read as TIMESTAMP_NTZ, as in ``schemas``.
    props = {"preferTimestampNTZ": "true", **properties}

    def read(table: str, predicates: list[str] | None) -> DataFrame:
        if predicates is None:
            return spark.read.jdbc(url, table, properties=props)
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)

    return read


def tables_from_reader(
    read: Reader,
    dialect: Dialect,
    table_names: Mapping[str, str],
    num_partitions: int = 64,
    time_column: str = "TRANSACTION_DATE",
    split_columns: Mapping[str, str] | None = None,
) -> TollTables:
    """The input bundle over any reader of predicate lists. ``table_names`` maps
    logical names to database tables (a name that is not there is its own);
    column names are lower-cased. ``split_columns`` replaces ``SPLIT_COLUMNS``
    for the logical names it has."""
    split = {**SPLIT_COLUMNS, **(split_columns or {})}

    def lower(df: DataFrame) -> DataFrame:
        return df.select([F.col(f"`{c}`").alias(c.lower()) for c in df.columns])

    def whole(name: str) -> DataFrame:
        table = table_names.get(name, name)
        if name in SMALL_TABLES:
            return lower(read(table, None))
        return lower(read(table, dialect.hash_predicates(split[name], num_partitions)))

    def gate_scan(name: str) -> GateScan:
        def scan(window: Window | None) -> DataFrame:
            if window is None:
                return whole(name)
            return lower(read(table_names.get(name, name), dialect.window_predicates(time_column, window, num_partitions)))

        return scan

    return TollTables(
        gate={kind: gate_scan(name) for kind, name in GATE_TABLES.items()},
        camera={kind: whole(name) for kind, name in CAMERA_TABLES.items()},
        **{name: whole(name) for name in OTHER_TABLES},
    )


def tables_from_jdbc(
    spark: SparkSession,
    url: str,
    table_names: Mapping[str, str] | None = None,
    properties: Mapping[str, str] | None = None,
    num_partitions: int = 64,
    time_column: str = "TRANSACTION_DATE",
    split_columns: Mapping[str, str] | None = None,
    hash_sql: str | None = None,
) -> TollTables:
    """Tables of the database at ``url``: see ``tables_from_reader``."""
    read = jdbc_reader(spark, url, properties or {})
    return tables_from_reader(read, dialect_of(url, hash_sql), table_names or {}, num_partitions, time_column, split_columns)


def tables_from_jdbc_file(spark: SparkSession, url: str, options_path: str | None) -> TollTables:
    """As ``tables_from_jdbc``, the other arguments from a JSON file of the
    keys ``table_names, properties, num_partitions, time_column,
    split_columns, hash_sql`` (all optional)."""
    options = {}
    if options_path:
        with open(options_path, encoding="utf-8") as f:
            options = json.load(f)
    return tables_from_jdbc(spark, url, **options)
