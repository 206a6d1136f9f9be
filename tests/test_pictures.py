"""Picture table over generated PNG files (SRC6, SRC7, FN10, FN11, JOB9)."""

from __future__ import annotations

import os
import struct
import zlib

import pytest

from gatewatch.plans.pictures import picture_names, picture_table, read_pictures, read_pictures_for


def write_png(path: str, width: int, height: int) -> None:
    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    raw = b"".join(b"\x00" + b"\x80\x40\x20" * width for _ in range(height))
    png = (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
        + chunk(b"IDAT", zlib.compress(raw))
        + chunk(b"IEND", b"")
    )
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(png)


def test_picture_table(spark, scratch):
    root = os.path.join(scratch, "pictures")
    write_png(os.path.join(root, "body", "1.png"), 70, 35)
    write_png(os.path.join(root, "plate", "1.png"), 140, 20)
    os.makedirs(os.path.join(root, "back"), exist_ok=True)
    with open(os.path.join(root, "back", "bad.png"), "wb") as f:
        f.write(b"not an image")

    wl = spark.createDataFrame(
        [("body/1.png", "plate/1.png", "back/bad.png"), (None, "plate/1.png", "back/missing.png")],
        "img_body string, img_plate string, img_back string",
    )
    names = {(r.kind, r.key): r.name for r in picture_names(wl).collect()}
    assert names == {
        ("body", "body/1.png"): "1.png",
        ("plate", "plate/1.png"): "1.png",
        ("back", "back/bad.png"): "bad.png",
        ("back", "back/missing.png"): "missing.png",
    }
    pics = read_pictures(spark, root)
    assert sorted(r.key for r in pics.collect()) == ["body/1.png", "plate/1.png"]  # invalid file dropped
    rows = {r.key: r for r in picture_table(wl, pics).collect()}
    assert (rows["body/1.png"].width, rows["body/1.png"].height) == (70, 35)
    assert abs(rows["body/1.png"].scale - 50 / 35) < 1e-9
    assert abs(rows["plate/1.png"].scale - 350 / 140) < 1e-9
    assert rows["back/missing.png"].width is None and rows["back/missing.png"].scale is None


def test_read_pictures_for_decodes_only_wanted_keys(spark, scratch):
    root = os.path.join(scratch, "pictures")
    write_png(os.path.join(root, "body", "1.png"), 70, 35)
    write_png(os.path.join(root, "body", "2.png"), 10, 20)
    write_png(os.path.join(root, "plate", "1.png"), 140, 20)
    wl = spark.createDataFrame(
        [("body/1.png", "plate/1.png", "back/missing.png")], "img_body string, img_plate string, img_back string"
    )
    keys = picture_names(wl)
    got = sorted(tuple(r) for r in read_pictures_for(spark, root, keys).collect())
    assert got == [("body/1.png", 70, 35), ("plate/1.png", 140, 20)]
    none = spark.createDataFrame([("body/none.png", None, None)], "img_body string, img_plate string, img_back string")
    assert read_pictures_for(spark, root, picture_names(none)).count() == 0


def write_by_java(spark, path: str, form: str, width: int, height: int) -> None:
    jvm = spark.sparkContext._jvm
    os.makedirs(os.path.dirname(path), exist_ok=True)
    image = jvm.java.awt.image.BufferedImage(width, height, 1)
    assert jvm.javax.imageio.ImageIO.write(image, form, jvm.java.io.File(path))


def test_header_sizes_equal_the_image_source(spark, scratch):
    root = os.path.join(scratch, "pictures")
    for n, (form, w, h) in enumerate([("png", 70, 35), ("jpg", 641, 257), ("gif", 300, 2), ("bmp", 13, 1029), ("jpg", 1, 1), ("png", 1, 4000)]):
        write_by_java(spark, os.path.join(root, "body", f"{n}.{form}"), form, w, h)
    with open(os.path.join(root, "body", "1.jpg"), "rb") as f:
        jpg = f.read()
    # An application segment as long as can be, fill bytes before a marker, and a frame header after it.
    segment = b"\xff\xe1" + (65_535).to_bytes(2, "big") + b"\xff\xc0" * 32_766 + b"\x00"
    with open(os.path.join(root, "body", "long.jpg"), "wb") as f:
        f.write(jpg[:2] + segment + b"\xff\xff\xff" + jpg[2:][1:] if jpg[2] == 0xFF else jpg)
    image = spark.read.format("image").option("recursiveFileLookup", True).option("dropInvalid", True).load(root)
    want = sorted((r.o.rsplit("/", 2)[-2] + "/" + r.o.rsplit("/", 1)[-1], r.width, r.height) for r in image.selectExpr("image.origin AS o", "image.width", "image.height").collect())
    got = sorted(tuple(r) for r in read_pictures(spark, root).collect())
    assert len(got) == 7 and got == want


@pytest.mark.parametrize("content", [b"", b"\xff\xd8", b"\xff\xd8\xff\xc0\x00", b"\x89PNG\r\n\x1a\n\x00", b"GIF89a\x01", b"BM", b"\xff\xd8\xff\xe0\x00\x00" * 3, b"\xff\xd8" + b"\xff" * 50])
def test_cut_headers_have_no_size(spark, scratch, content):
    path = os.path.join(scratch, "p", "body", "x.jpg")
    os.makedirs(os.path.dirname(path))
    with open(path, "wb") as f:
        f.write(content)
    assert read_pictures(spark, os.path.join(scratch, "p")).collect() == []


def files_read(df) -> int:
    """How many files the executed plan's scans opened."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while "QueryStage" in leaf.getClass().getName():
            leaf = leaf.plan().collectLeaves().apply(0)
        if leaf.metrics().contains("numFiles"):
            total += leaf.metrics().apply("numFiles").value()
    return total


def test_unwanted_files_are_not_opened(spark, scratch):
    root = os.path.join(scratch, "pictures")
    write_png(os.path.join(root, "body", "1.png"), 70, 35)
    write_png(os.path.join(root, "body", "a b%20c.png"), 3, 4)
    write_png(os.path.join(root, "plate", "1.png"), 9, 9)  # the same name in another folder
    for n in range(20):
        with open(os.path.join(root, "body", f"corrupt{n}.png"), "wb") as f:
            f.write(b"\x89PNG\r\n\x1a\n")
    keys = spark.createDataFrame([("body/1.png",), ("body/a b%20c.png",), ("body/none.png",), (None,), ("body/1.png",)], "key string")
    found = read_pictures_for(spark, root, keys)
    assert sorted(tuple(r) for r in found.collect()) == [("body/1.png", 70, 35), ("body/a b%20c.png", 3, 4)]
    assert files_read(found) == 3
    # Beyond the list of names every file is opened, with the same result.
    wide = read_pictures_for(spark, root, keys, listed=1)
    assert sorted(tuple(r) for r in wide.collect()) == sorted(tuple(r) for r in found.collect())
    assert files_read(wide) == 23
