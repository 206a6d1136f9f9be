from __future__ import annotations

import os
import sys
import tempfile
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from gatewatch.schemas import INPUTS  # noqa: E402
from gatewatch.sources.tables import tables_from_frames  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("gatewatch-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gatewatch-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="gatewatch-test-")


def ts(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def txn(tid, when, l1="K1", l2="100", prov=1, wheel="VWHEL0001", fee=10, deleted=0, ref=None):
    return (tid, ts(when) if isinstance(when, str) else when, ref if ref is not None else tid * 7, l1, l2, prov, wheel, fee, deleted)


def wl_row(p1="K1", p2="100", province="%", list_type=1, body="body/w.png", plate="plate/w.png", back="back/w.png", model="M", color="C"):
    return (p1, p2, province, list_type, body, plate, back, p1, p2, "ORIGIN", model, color)


def make_tables(spark, **rows):
    """TollTables from in-memory rows; unspecified tables are empty, except a
    default province office (code 1 -> 'PROV_1') and list type (1 -> 'LIST')."""
    defaults = {
        "province_office": [(1, "PROV_1"), (2, "PROV_2")],
        "watchlist_type": [(1, "LIST"), (2, "OTHER")],
    }
    frames = {}
    for name, schema in INPUTS.items():
        data = rows.get(name, defaults.get(name, []))
        frames[name] = spark.createDataFrame(data, schema)
    return tables_from_frames(frames)
