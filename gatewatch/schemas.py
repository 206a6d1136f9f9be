"""Explicit schemas of the inputs and outputs (types inferred from the SQL's use)."""

from pyspark.sql import types as T

S, L, I, TS, D, DB = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.TimestampNTZType(),
    T.DateType(),
    T.DoubleType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


GATE_TXN = _struct(
    ("transaction_id", L),
    ("transaction_date", TS),
    ("ref_transaction_id", L),
    ("vehicle_license_1", S),
    ("vehicle_license_2", S),
    ("vehicle_province", I),
    ("vehicle_wheel_code", S),
    ("fee_amount", L),
    ("delete_flag", I),
)

# Enriched transaction row: the 11 columns of the reference's inner UNION.
SOURCE_ROW_COLUMNS = [
    "transaction_id",
    "transaction_date",
    "ref_transaction_id",
    "vehicle_license_1",
    "vehicle_license_2",
    "description",
    "vehicle_class",
    "mem_type",
    "body_path_pic",
    "plate_path_pic",
    "back_path_pic",
]

# Hit result, 22 columns in the reference's order.
HIT_COLUMNS = SOURCE_ROW_COLUMNS + [
    "img_body",
    "img_plate",
    "img_back",
    "plate1_origin",
    "plate2_origin",
    "province_origin",
    "status",
    "create_channel",
    "model",
    "color",
    "rn",
]

REPORT = _struct(
    ("transaction_id", L),
    ("transaction_time", S),
    ("plate", S),
    ("province", S),
    ("vehicle_class", S),
    ("user_type", S),
    ("body_key", S),
    ("plate_key", S),
    ("back_key", S),
    ("correct_plate", S),
    ("body_url", S),
    ("plate_url", S),
    ("back_url", S),
    ("report_date", D),
    ("slot", S),
)
REPORT_COLUMNS = ["report_date", "slot"] + [f.name for f in REPORT.fields[:-2]]

# One record per run; ``run_id`` (sortable by time) names the folder it wrote.
REPORT_RUNS = _struct(("run_id", S), ("row_count", L), ("list_name", S), ("report_date", D), ("slot", S))

CAMERA = _struct(("transaction_id", L), ("body_path_pic", S), ("plate_path_pic", S))
INPUTS = {
    "member_txn": GATE_TXN,
    "nonmember_txn": GATE_TXN,
    "illegal_txn": GATE_TXN,
    "member_camera": CAMERA,
    "nonmember_camera": CAMERA,
    "illegal_camera": CAMERA,
    "province_office": _struct(("code", I), ("description", S)),
    "back_camera": _struct(("ref_transaction_id", L), ("back_path_pic", S), ("delete_flag", I)),
    "invoice_rollback": _struct(("plate1", S), ("plate2", S), ("province", I)),
    "member_invoice": _struct(("invoice_no", L), ("status", S)),
    "nonmember_invoice": _struct(("invoice_no", L), ("status", S)),
    "member_invoice_detail": _struct(("invoice_no", L), ("create_channel", S), ("transaction_id", L)),
    "nonmember_invoice_detail": _struct(("invoice_no", L), ("create_channel", S), ("transaction_id", L)),
    "watchlist_master": _struct(
        ("plate1", S),
        ("plate2", S),
        ("province", S),
        ("list_type", I),
        ("img_body", S),
        ("img_plate", S),
        ("img_back", S),
        ("plate1_origin", S),
        ("plate2_origin", S),
        ("province_origin", S),
        ("model", S),
        ("color", S),
    ),
    "watchlist_type": _struct(("id", I), ("list_name", S)),
}
