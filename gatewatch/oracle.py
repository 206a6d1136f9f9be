"""Oracle SQL for the correctness check: DuckDB text over the driver tables.

The fixture views (FIXTURES.md section 1) are written once as SQL here. The
queries are built from named steps of their own (see ``STEPS``) and spell out
every constant, so a wrong slot, exclusion or tie-break in the engine shows as
a mismatch. Test infrastructure only: nothing is imported from the engine, and
the library never builds SQL text.
"""

from __future__ import annotations

FIXTURE_VIEWS = {
    "province_office": "SELECT CAST(n_nationkey AS INTEGER) AS code, n_name AS description FROM nation",
    "back_camera": (
        "SELECT event_id * 7 AS ref_transaction_id, "
        "concat('back/', CAST(event_id AS VARCHAR), '.png') AS back_path_pic, "
        "CAST(CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS delete_flag "
        "FROM events WHERE event_id % 2 = 0"
    ),
    "invoice_rollback": (
        "SELECT concat('K', CAST(c_custkey % 10 AS VARCHAR)) AS plate1, CAST(c_custkey AS VARCHAR) AS plate2, "
        "CAST(c_custkey % 25 AS INTEGER) AS province FROM "
        "(SELECT c_custkey FROM customer WHERE c_custkey % 6 = 0 "
        "UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 12 = 0) r"
    ),
    "member_invoice": "SELECT o_orderkey AS invoice_no, o_orderstatus AS status FROM orders WHERE o_orderkey % 2 = 0",
    "nonmember_invoice": "SELECT o_orderkey AS invoice_no, o_orderstatus AS status FROM orders WHERE o_orderkey % 3 = 0",
    "member_invoice_detail": (
        "SELECT l_orderkey AS invoice_no, l_returnflag AS create_channel, l_orderkey AS transaction_id "
        "FROM lineitem WHERE l_orderkey % 2 = 0"
    ),
    "nonmember_invoice_detail": (
        "SELECT l_orderkey AS invoice_no, l_returnflag AS create_channel, l_orderkey AS transaction_id "
        "FROM lineitem WHERE l_orderkey % 3 = 0"
    ),
    "watchlist_master": (
        "SELECT concat('K', CAST(c_custkey % 10 AS VARCHAR)) AS plate1, CAST(c_custkey AS VARCHAR) AS plate2, "
        "CASE WHEN c_custkey % 3 = 0 THEN '%' WHEN c_custkey % 3 = 1 THEN 'NATION_1%' "
        "ELSE concat('NATION_', CAST(c_custkey % 25 AS VARCHAR)) END AS province, "
        "CAST(c_nationkey % 5 AS INTEGER) AS list_type, "
        "CASE WHEN c_custkey % 4 <> 0 THEN concat('body/', CAST(c_custkey AS VARCHAR), '.png') END AS img_body, "
        "concat('plate/', CAST(c_custkey AS VARCHAR), '.png') AS img_plate, "
        "CASE WHEN c_custkey % 5 <> 0 THEN concat('back/', CAST(c_custkey AS VARCHAR), '.png') END AS img_back, "
        "concat('K', CAST(c_custkey % 10 AS VARCHAR)) AS plate1_origin, CAST(c_custkey AS VARCHAR) AS plate2_origin, "
        "concat('NATION_', CAST(c_nationkey AS VARCHAR)) AS province_origin, "
        "c_name AS model, c_mktsegment AS color FROM customer"
    ),
    "watchlist_type": "SELECT CAST(r_regionkey AS INTEGER) AS id, r_name AS list_name FROM region",
}

_TXN = (
    "SELECT event_id AS transaction_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS transaction_date, "
    "event_id * 7 AS ref_transaction_id, concat('K', CAST(user_id % 10 AS VARCHAR)) AS vehicle_license_1, "
    "CAST(user_id AS VARCHAR) AS vehicle_license_2, CAST(user_id % 25 AS INTEGER) AS vehicle_province, "
    "concat('VWHEL000', CAST(event_id % 5 AS VARCHAR)) AS vehicle_wheel_code, "
    "CAST(floor(value / 5) AS BIGINT) AS fee_amount, "
    "CAST(CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS INTEGER) AS delete_flag "
    "FROM events WHERE {pred}"
)
_CAM = (
    "SELECT event_id AS transaction_id, concat('body/', CAST(event_id AS VARCHAR), '.png') AS body_path_pic, "
    "concat('plate/', CAST(event_id AS VARCHAR), '.png') AS plate_path_pic "
    "FROM events WHERE {pred} AND event_id % 3 <> 0"
)
_KIND_PRED = {
    "member": "event_type IN ('click', 'purchase')",
    "nonmember": "event_type IN ('view', 'signup')",
    "illegal": "event_type = 'error'",
}
FIXTURE_VIEWS["report_runs"] = (
    "SELECT DISTINCT CASE WHEN user_id % 2 = 0 THEN 'ASIA' ELSE 'OTHER' END AS list_name, CAST(ts AS DATE) AS report_date, "
    "CASE event_type WHEN 'click' THEN 'DAY-1' WHEN 'purchase' THEN 'DAY' WHEN 'view' THEN 'AFTERNOON' ELSE 'NIGHT' END AS slot "
    "FROM events WHERE event_id % 23 = 0"
)
FIXTURE_VIEWS["run_records"] = (
    "SELECT CASE WHEN user_id % 2 = 0 THEN 'ASIA' ELSE 'OTHER' END AS list_name, CAST(ts AS DATE) AS report_date, "
    "CASE event_type WHEN 'click' THEN 'DAY-1' WHEN 'purchase' THEN 'DAY' WHEN 'view' THEN 'AFTERNOON' ELSE 'NIGHT' END AS slot, "
    "max(value) AS run_at FROM events GROUP BY ALL"
)
FIXTURE_VIEWS["stored_ids"] = "SELECT event_id AS transaction_id FROM events WHERE event_id % 5 = 0"
FIXTURE_VIEWS["stored_pictures"] = (
    "SELECT concat(kind, '/', CAST(c_custkey AS VARCHAR), '.png') AS key, CAST(c_custkey % 700 AS INTEGER) AS width, "
    "CAST(c_custkey % 400 AS INTEGER) AS height FROM customer, (VALUES ('body'), ('plate'), ('back')) k(kind) WHERE c_custkey % 7 <> 0"
)
for _k, _p in _KIND_PRED.items():
    FIXTURE_VIEWS[f"{_k}_txn"] = _TXN.format(pred=_p)
    FIXTURE_VIEWS[f"{_k}_camera"] = _CAM.format(pred=_p)


ALL_VIEWS = tuple(FIXTURE_VIEWS)
LIST = "ASIA"
RUN = "2024-01-12"
PREFIX = "https://pictures.invalid/download/"
WHEEL = (
    "CASE vehicle_wheel_code WHEN 'VWHEL0001' THEN 'C1' WHEN 'VWHEL0002' THEN 'C2' WHEN 'VWHEL0003' THEN 'C3' "
    "ELSE 'Unknown' END"
)
GATE = (
    "mem_type, transaction_id, transaction_date, ref_transaction_id, vehicle_license_1, vehicle_license_2, "
    "vehicle_province, vehicle_wheel_code, fee_amount, delete_flag"
)
SOURCE = (
    "transaction_id, transaction_date, ref_transaction_id, vehicle_license_1, vehicle_license_2, description, "
    "vehicle_class, mem_type, body_path_pic, plate_path_pic, back_path_pic"
)
MATCH = "img_body, img_plate, img_back, plate1_origin, plate2_origin, province_origin, model, color"
# Who comes first among the hits of one vehicle at one time; NULLs last.
FIRST = (
    "transaction_id, status, create_channel, model, color, img_body, img_plate, img_back, plate1_origin, plate2_origin, "
    "province_origin, body_path_pic, plate_path_pic, back_path_pic, mem_type, vehicle_class, ref_transaction_id, "
    "vehicle_license_1, vehicle_license_2"
)
# slot, code, first day before the run date, last hour, folder, suffix
SLOT_ROWS = (
    "('DAY-1', 'C', 2, 8, 'ASIA_1_Day_Ago', '-Day-1'), ('DAY', 'A', 0, 11, 'ASIA', '_Day'), "
    "('AFTERNOON', 'D', 0, 14, 'ASIA', '_Afternoon'), ('NIGHT', 'B', 0, 16, 'ASIA', '_Night')"
)
# Windows on the run date 2024-01-12, and what each report leaves out: the
# windows of the reports that came before it.
WINDOWS = {
    "DAY-1": ("2024-01-10 00:00:00", "2024-01-12 08:00:00"),
    "DAY": ("2024-01-12 00:00:00", "2024-01-12 11:00:00"),
    "AFTERNOON": ("2024-01-12 00:00:00", "2024-01-12 14:00:00"),
    "NIGHT": ("2024-01-12 00:00:00", "2024-01-12 16:00:00"),
}
BEFORE = {
    "DAY-1": (
        ("2024-01-08 00:00:00", "2024-01-10 08:00:00"),
        ("2024-01-10 00:00:00", "2024-01-10 16:00:00"),
        ("2024-01-09 00:00:00", "2024-01-11 08:00:00"),
        ("2024-01-11 00:00:00", "2024-01-11 16:00:00"),
    ),
    "DAY": (WINDOWS["DAY-1"],),
    "AFTERNOON": (WINDOWS["DAY"], WINDOWS["DAY-1"]),
    "NIGHT": (WINDOWS["DAY-1"], WINDOWS["DAY"], WINDOWS["AFTERNOON"]),
}
OVERNIGHT = ("2024-01-11 17:00:00", "2024-01-12 11:00:00")
HEADER_LENGTHS = {
    "transaction_id": 14, "transaction_time": 6, "plate": 11, "province": 7, "vehicle_class": 11, "user_type": 17, "correct_plate": 22,
}


def _steps(lo: str | None = None, hi: str | None = None) -> dict[str, str]:
    """The steps of the hit query, in order; each may use the ones before."""
    inside = f"transaction_date BETWEEN TIMESTAMP '{lo}' AND TIMESTAMP '{hi}'" if lo else "TRUE"
    group = "mem_type, transaction_date, vehicle_license_1, vehicle_license_2, vehicle_province"
    return {
        "gate": "SELECT 'MEMBER' AS mem_type, * FROM member_txn UNION ALL SELECT 'NON-MEMBER', * FROM nonmember_txn "
        "UNION ALL SELECT 'ILLIGAL', * FROM illegal_txn",
        "cameras": "SELECT 'MEMBER' AS mem_type, * FROM member_camera UNION ALL SELECT 'NON-MEMBER', * FROM nonmember_camera "
        "UNION ALL SELECT 'ILLIGAL', * FROM illegal_camera",
        "alone": f"SELECT * FROM gate WHERE {inside} AND vehicle_license_1 IS NOT NULL AND vehicle_license_2 IS NOT NULL "
        f"AND vehicle_province IS NOT NULL AND transaction_date IS NOT NULL QUALIFY count(*) OVER (PARTITION BY {group}) = 1",
        "rear": "SELECT ref_transaction_id, back_path_pic FROM back_camera WHERE delete_flag = 0",
        "source": f"SELECT DISTINCT {SOURCE} FROM (SELECT *, {WHEEL} AS vehicle_class FROM alone WHERE fee_amount > 0 AND delete_flag = 0) "
        "JOIN (SELECT code AS vehicle_province, description FROM province_office) USING (vehicle_province) "
        "LEFT JOIN cameras USING (mem_type, transaction_id) LEFT JOIN rear USING (ref_transaction_id)",
        "bills": "SELECT DISTINCT status, create_channel, transaction_id FROM ("
        "SELECT * FROM member_invoice JOIN member_invoice_detail USING (invoice_no) UNION ALL "
        "SELECT * FROM nonmember_invoice JOIN nonmember_invoice_detail USING (invoice_no))",
        "listed": f"SELECT * FROM watchlist_master WHERE list_type IN (SELECT id FROM watchlist_type WHERE list_name = '{LIST}')",
    }


def _matched(entries: str) -> str:
    return (
        f"SELECT s.*, {MATCH} FROM source s, {entries} w WHERE w.plate1 = s.vehicle_license_1 "
        "AND w.plate2 = s.vehicle_license_2 AND s.description LIKE w.province"
    )


def hits_sql_body(lo: str | None, hi: str | None, list_name: str = LIST) -> str:
    """The hits of a window (22 columns), as a query of its own."""
    steps = _steps(lo, hi)
    steps["listed"] = steps["listed"].replace(f"'{LIST}'", f"'{list_name}'")
    steps["matched"] = _matched("listed")
    first = ", ".join(f"{c.strip()} NULLS LAST" for c in FIRST.split(","))
    return (
        "WITH " + ", ".join(f"{k} AS ({v})" for k, v in steps.items()) + f" SELECT {SOURCE}, img_body, img_plate, img_back, "
        "plate1_origin, plate2_origin, province_origin, status, create_channel, model, color, CAST(1 AS BIGINT) AS rn "
        "FROM matched LEFT JOIN bills USING (transaction_id) QUALIFY row_number() OVER (PARTITION BY transaction_date, "
        f"coalesce(vehicle_license_1, '') || ' ' || coalesce(vehicle_license_2, ''), description ORDER BY {first}) = 1"
    )


def with_views(body: str, views=ALL_VIEWS, steps: dict[str, str] | None = None) -> str:
    named = {v: FIXTURE_VIEWS[v] for v in views} | (steps or {})
    if body.startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in named.items())
    return f"WITH {ctes}\n{body}"


def report_projection_sql(hits: str, report_date: str, slot: str, prefix: str) -> str:
    def url(c: str) -> str:
        return f"CASE WHEN coalesce(h.{c}, '') <> '' THEN '{prefix}' || h.{c} || '?key=' ELSE '' END"

    time_text = (
        "CASE WHEN date_trunc('second', h.transaction_date) = h.transaction_date "
        "THEN strftime(h.transaction_date, '%Y-%m-%d %H:%M:%S') "
        "ELSE strftime(h.transaction_date, '%Y-%m-%d %H:%M:%S.%f') END"
    )
    return f"""SELECT DATE '{report_date}' AS report_date, '{slot}' AS slot, h.transaction_id,
  coalesce({time_text}, '') AS transaction_time,
  coalesce(h.vehicle_license_1, '') || ' ' || coalesce(h.vehicle_license_2, '') AS plate,
  coalesce(h.description, '') AS province, coalesce(h.vehicle_class, '') AS vehicle_class,
  coalesce(h.mem_type, '') AS user_type, coalesce(h.img_body, '') AS body_key,
  coalesce(h.img_plate, '') AS plate_key, coalesce(h.img_back, '') AS back_key,
  coalesce(h.plate1_origin, '') || ' ' || coalesce(h.plate2_origin, '') || ' ' || coalesce(h.province_origin, '') AS correct_plate,
  {url('body_path_pic')} AS body_url, {url('plate_path_pic')} AS plate_url, {url('back_path_pic')} AS back_url
FROM ({hits}) h"""


def width_profile_sql(hits: str, header_lengths: dict[str, int]) -> str:
    def longest(expr: str, null_text: str = "None") -> str:
        return f"coalesce(max(length(coalesce(CAST({expr} AS VARCHAR), '{null_text}'))), 0)"

    time_text = (
        "CASE WHEN date_trunc('second', transaction_date) = transaction_date "
        "THEN strftime(transaction_date, '%Y-%m-%d %H:%M:%S') "
        "ELSE strftime(transaction_date, '%Y-%m-%d %H:%M:%S.%f') END"
    )
    widths = {
        "transaction_id": longest("transaction_id"),
        "transaction_time": longest(time_text, "NaT"),
        "plate": f"{longest('vehicle_license_1')} + {longest('vehicle_license_2')}",
        "province": longest("description"),
        "vehicle_class": longest("vehicle_class"),
        "user_type": longest("mem_type"),
        "correct_plate": f"{longest('plate1_origin')} + {longest('plate2_origin')} + {longest('province_origin')}",
    }
    cols = ",\n  ".join(
        f"CAST(greatest({expr}, {header_lengths[name]}) AS BIGINT) AS width_{name}" for name, expr in widths.items()
    )
    return f"SELECT {cols}\nFROM ({hits}) h"


def oracle_queries() -> dict[str, str]:
    """Oracle SQL for every key of the registered queries."""
    days = (
        "(SELECT CAST(unnest(generate_series(min(CAST(transaction_date AS DATE)), max(CAST(transaction_date AS DATE)), "
        "INTERVAL 1 DAY)) AS DATE) AS run_date FROM gate)"
    )
    slots = f"(VALUES {SLOT_ROWS}) t(slot, slot_code, lo_days, hi_h, folder, suffix)"
    expected = (
        "SELECT run_date AS report_date, slot, 'WatchList/' || folder || '/' || strftime(run_date, '%Y-%m-%d') "
        f"|| '/{LIST}_List_' || strftime(run_date, '%Y-%m-%d') || suffix || '.xlsx' AS object_name FROM {days}, {slots}"
    )
    names = " UNION ".join(
        f"SELECT '{kind}' AS kind, img_{kind} AS key, replace(img_{kind}, '{kind}/', '') AS name FROM watchlist_master "
        f"WHERE img_{kind} <> ''"
        for kind in ("body", "plate", "back")
    )
    rollback = (
        "gate g LEFT JOIN invoice_rollback r ON (r.plate1, r.plate2, r.province) = "
        "(g.vehicle_license_1, g.vehicle_license_2, g.vehicle_province)"
    )

    def ids(windows) -> str:
        return " UNION ".join(f"SELECT transaction_id FROM ({hits_sql_body(*w)})" for w in windows)

    def report(slot: str) -> str:
        fresh = f"SELECT * FROM ({hits_sql_body(*WINDOWS[slot])}) WHERE transaction_id NOT IN ({ids(BEFORE[slot])})"
        return report_projection_sql(fresh, RUN, slot, PREFIX)

    # Reports of one day in a store that has no earlier days.
    earlier = {"DAY-1": (), "DAY": ("DAY-1",), "AFTERNOON": ("DAY-1", "DAY"), "NIGHT": ("DAY-1", "DAY", "AFTERNOON")}

    def of_the_day(slot: str) -> str:
        own = hits_sql_body(*WINDOWS[slot])
        left_out = f" WHERE transaction_id NOT IN ({ids([WINDOWS[s] for s in earlier[slot]])})" if earlier[slot] else ""
        return report_projection_sql(f"SELECT * FROM ({own}){left_out}", RUN, slot, PREFIX)

    stored = " UNION ALL ".join(f"SELECT *, '{LIST}' AS list_name FROM ({of_the_day(slot)})" for slot in WINDOWS)
    needs = (
        "(VALUES ('DAY-1', 2, 'DAY-1'), ('DAY-1', 2, 'DAY'), ('DAY-1', 2, 'AFTERNOON'), ('DAY-1', 2, 'NIGHT'), "
        "('DAY-1', 1, 'DAY-1'), ('DAY-1', 1, 'DAY'), ('DAY-1', 1, 'AFTERNOON'), ('DAY-1', 1, 'NIGHT'), ('DAY', 0, 'DAY-1'), "
        "('AFTERNOON', 0, 'DAY'), ('AFTERNOON', 0, 'DAY-1'), ('NIGHT', 0, 'DAY-1'), ('NIGHT', 0, 'DAY'), ('NIGHT', 0, 'AFTERNOON')) n(slot, back, name)"
    )
    lookback = hits_sql_body(*WINDOWS["DAY-1"])
    lo, hi = WINDOWS["DAY-1"]
    q = {
        "stale_reports": (
            f"SELECT r.list_name, r.report_date, r.slot, o.report_date AS newer_date, o.slot AS newer_slot FROM run_records r, {needs}, run_records o "
            "WHERE n.slot = r.slot AND o.slot = n.name AND o.list_name = r.list_name AND o.report_date = r.report_date - CAST(n.back AS INTEGER) "
            "AND o.run_at > r.run_at"
        ),
        "stored_reports": stored,
        "report_of_id": (
            f"SELECT transaction_id, list_name, report_date, slot FROM ({stored}) WHERE transaction_id IN (SELECT transaction_id FROM member_txn)"
        ),
        "camera_lookup_reduced": (
            f"SELECT * FROM member_camera WHERE transaction_id IN (SELECT transaction_id FROM member_txn WHERE fee_amount > 0 AND delete_flag = 0 "
            f"AND transaction_date BETWEEN TIMESTAMP '{lo}' AND TIMESTAMP '{hi}' UNION SELECT min(transaction_id) FROM member_txn "
            "UNION SELECT max(transaction_id) FROM member_txn)"
        ),
        "scan_gate_txn": f"SELECT {GATE} FROM gate",
        "filter_window_inclusive": f"SELECT {GATE} FROM gate WHERE transaction_date >= TIMESTAMP '{lo}' AND transaction_date <= TIMESTAMP '{hi}'",
        "paid_active_txn": f"SELECT {GATE} FROM gate WHERE fee_amount > 0 AND delete_flag = 0",
        "singleton_groups": f"SELECT {GATE} FROM alone",
        "province_lookup": f"SELECT {GATE}, description FROM gate, province_office WHERE code = vehicle_province",
        "camera_left_join": f"SELECT {GATE}, body_path_pic, plate_path_pic FROM gate LEFT JOIN cameras USING (mem_type, transaction_id)",
        "back_camera_left_join": f"SELECT {GATE}, back_path_pic FROM gate LEFT JOIN rear USING (ref_transaction_id)",
        "dead_left_join_dedup": f"SELECT DISTINCT {', '.join('g.' + c.strip() for c in GATE.split(','))} FROM {rollback}",
        "rollback_left_join": f"SELECT {', '.join('g.' + c.strip() for c in GATE.split(','))} FROM {rollback}",
        "vehicle_class_case": f"SELECT mem_type, transaction_id, vehicle_wheel_code, {WHEEL} AS vehicle_class FROM gate",
        "source_union_distinct": "SELECT * FROM source",
        "invoice_union_distinct": "SELECT * FROM bills",
        "invoice_status_left_join": f"SELECT {SOURCE}, status, create_channel FROM source LEFT JOIN bills USING (transaction_id)",
        "watchlist_type_filter": "SELECT * FROM listed",
        "watchlist_like_join": _matched("watchlist_master"),
        "first_hit_per_vehicle": hits_sql_body(None, None),
        "hits_lookback": lookback,
        "watchlist_hits": hits_sql_body(*WINDOWS["NIGHT"]),
        "hits_overnight": hits_sql_body(*OVERNIGHT),
        "slot_windows": (
            "SELECT run_date, slot, slot_code, CAST(run_date - CAST(lo_days AS INTEGER) AS TIMESTAMP) AS lo, "
            f"CAST(run_date AS TIMESTAMP) + to_hours(CAST(hi_h AS BIGINT)) AS hi FROM {days}, {slots}"
        ),
        "published_ids": ids(BEFORE["NIGHT"]),
        "report_day_1": report("DAY-1"),
        "report_day": report("DAY"),
        "report_afternoon": report("AFTERNOON"),
        "report_night": report("NIGHT"),
        "report_columns": report_projection_sql(lookback, RUN, "DAY-1", PREFIX),
        "report_width_profile": width_profile_sql(lookback, HEADER_LENGTHS),
        "picture_names": names,
        "picture_scale": (
            f"SELECT key, name, width, height, CASE kind WHEN 'plate' THEN 350.0 / nullif(width, 0) ELSE 50.0 / nullif(height, 0) END AS scale "
            f"FROM ({names}) LEFT JOIN stored_pictures USING (key)"
        ),
        "expected_reports": expected,
        "missing_reports": (
            f"SELECT * FROM ({expected}) WHERE (report_date, slot) NOT IN (SELECT (report_date, slot) FROM report_runs WHERE list_name = '{LIST}')"
        ),
        "fresh_against_stored": f"SELECT * FROM ({lookback}) WHERE transaction_id NOT IN (SELECT transaction_id FROM stored_ids)",
    }
    return {name: with_views(body, steps=_steps()) for name, body in q.items()}
