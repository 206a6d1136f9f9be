"""Width and height of a picture from its file header, as column expressions.

Nothing is decoded: PNG, GIF and BMP carry their size at a fixed place; a JPEG
is walked from segment to segment to its frame header. A file of none of these
forms has no size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first bytes of each form, and the JPEG markers of a frame
# header (SOF) and of segments without a length.
PNG = "89504E470D0A1A0A"
GIF = "474946"
BMP = "424D"
JPEG = "FFD8"
FRAMES = [0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF]
BARE = [0x01, *range(0xD0, 0xD9)]


def _unsigned(content: Column, at: Column | int, n: int, little: bool = False) -> Column:
    """The unsigned number in the ``n`` bytes from place ``at`` (from 0); null
    beyond the end of the file."""
    at = F.lit(at) if isinstance(at, int) else at
    places = [at + (n - i if little else i + 1) for i in range(n)]
    hexes = F.concat(*[F.hex(F.substring(content, p.cast("int"), F.lit(1))) for p in places])
    return F.when(F.length(hexes) == 2 * n, F.conv(hexes, 16, 10).cast("long"))


def _frame_start(content: Column) -> Column:
    """Place of a JPEG's frame header, or null. Every segment moves on by at
    least two bytes, so the walk has an end; once it is over the steps that are
    left cost nothing."""
    size = F.octet_length(content)
    done = lambda at, found: F.struct(at.cast("int").alias("at"), found.alias("found"), F.lit(True).alias("over"))
    go = lambda at: F.struct(at.cast("int").alias("at"), F.lit(False).alias("found"), F.lit(False).alias("over"))
    byte = lambda i: _unsigned(content, i, 1)

    def step(s: Column, _: Column) -> Column:
        at = s["at"]
        moved = (
            F.when((at + 9 > size) | (byte(at) != 0xFF), done(at, F.lit(False)))
            .when(byte(at + 1) == 0xFF, go(at + 1))
            .when(byte(at + 1).isin(FRAMES), done(at, F.lit(True)))
            .when(byte(at + 1).isin(BARE), go(at + 2))
            .otherwise(go(at + 2 + _unsigned(content, at + 2, 2)))
        )
        return F.when(s["over"], s).otherwise(moved)

    end = F.aggregate(F.sequence(F.lit(0), F.greatest(size, F.lit(0))), go(F.lit(2)), step)
    return F.get(F.transform(F.array(end), lambda s: F.when(s["found"], s["at"])), F.lit(0))


def image_size(content: Column) -> Column:
    """``struct<width: int, height: int>`` of a picture's bytes; null if its
    form is not known or the header is cut short."""
    start = F.hex(F.substring(content, F.lit(1), F.lit(8)))
    pair = lambda w, h: F.when(w.isNotNull() & h.isNotNull(), F.struct(w.cast("int").alias("width"), h.cast("int").alias("height")))
    # A BMP may be stored top-down, with a negative height.
    signed = lambda x: F.abs(F.when(x >= 1 << 31, x - (1 << 32)).otherwise(x))
    jpeg = F.transform(
        F.array(_frame_start(content)),
        lambda at: F.when(at.isNotNull(), pair(_unsigned(content, at + 7, 2), _unsigned(content, at + 5, 2))),
    )
    return (
        F.when(start == PNG, pair(_unsigned(content, 16, 4), _unsigned(content, 20, 4)))
        .when(start.startswith(GIF), pair(_unsigned(content, 6, 2, True), _unsigned(content, 8, 2, True)))
        .when(start.startswith(JPEG), F.get(jpeg, F.lit(0)))
        .when(start.startswith(BMP), pair(signed(_unsigned(content, 18, 4, True)), signed(_unsigned(content, 22, 4, True))))
    )
