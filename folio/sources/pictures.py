"""Pictures embedded in decks, as a table of their bytes; equal ones once, and the picture that a scanned page consists of.

Edge cases: files that are no decks, links to parts that are missing, and pictures whose head is not known (size null) have defined rows or none: a broken
deck gives no rows, a missing part none, an unknown head a row without a size, which `once` leaves out. Repeated files are read as often as given.
No files give no rows; other columns of the files are not read. Pictures stay where the table is: what meets in a shuffle is their digest.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zipfile
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.geometry import area
from folio.sources.decks import _A, _R, _related, slices

MEDIA = "path string, slide_no int, place int, part string, width int, height int, sha1 string, content binary"
#: Pixels of the shorter side below which a picture is a mark.
LEAST_SIDE = 48
#: Bytes of pictures that are handed on together.
MOST_BYTES = 1 << 20


def size_of(data: bytes) -> tuple[int, int] | None:
    """Width and height by a picture's head: PNG, GIF, BMP and JPEG."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if data[:4] == b"GIF8" and len(data) >= 10:
        return struct.unpack("<HH", data[6:10])
    if data[:2] == b"BM" and len(data) >= 26:
        return struct.unpack("<i", data[18:22])[0], abs(struct.unpack("<i", data[22:26])[0])
    at = 2
    while data[:2] == b"\xff\xd8" and at + 9 <= len(data) and data[at] == 0xFF:
        if 0xC0 <= data[at + 1] <= 0xCF and data[at + 1] not in (0xC4, 0xC8, 0xCC):  # a frame's head
            high, wide = struct.unpack(">HH", data[at + 5 : at + 9])
            return wide, high
        at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


def pictures_of(content: bytes):
    """(slide_no, place, part, bytes) of the pictures that a deck's slides show, in their order on the slide."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        parts = set(z.namelist())
        for name in sorted((n for n in parts if re.fullmatch(r"ppt/slides/slide[0-9]+\.xml", n)), key=lambda n: int(re.sub(r"\D", "", n))):
            links = _related(z, name)
            shown = [links.get(b.get(f"{_R}embed"), "") for b in ElementTree.fromstring(z.read(name)).iter(f"{_A}blip")]
            for place, part in enumerate(p for p in shown if p in parts):
                yield int(re.sub(r"\D", "", name)), place, part, z.read(part)


def embedded(files: DataFrame) -> DataFrame:
    """(path, slide_no, place, part, width, height, sha1, content) of the pictures in decks; files(path, content)."""
    names = [c.split(" ")[0] for c in MEDIA.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([pa.field(*(lambda n, k: (n, kinds[k]))(*c.split(" "))) for c in MEDIA.split(", ")])

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], names=names)

    def read(batches):
        for b in slices(batches):
            rows, size = [], 0
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                try:
                    found = list(pictures_of(content.as_py() or b""))
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError):
                    continue
                for slide, place, part, data in found:
                    rows.append([path, slide, place, part, *(size_of(data) or (None, None)), hashlib.sha1(data).hexdigest(), data])
                    size += len(data)
                    if size > MOST_BYTES:  # large ones leave at once
                        yield batch(rows)
                        rows, size = [], 0
            if rows:
                yield batch(rows)

    return files.select("path", "content").mapInArrow(read, MEDIA)


def once(media: DataFrame, book: list[str] | None = None, least: int = LEAST_SIDE) -> DataFrame:
    """(book, sha1, slide_no, place, width, height, n): each picture of a deck once, where it stands first, with how often it stands there; pictures with a
    side of under `least` pixels are left out."""
    book = book or ["path"]
    rows = media.filter(F.least("width", "height") >= least)
    first = F.min(F.struct("slide_no", "place")).alias("first")
    return rows.groupBy(*book, "sha1").agg(first, F.min("width").alias("width"), F.min("height").alias("height"), F.count(F.lit(1)).alias("n")).select(*book, "sha1", "first.slide_no", "first.place", "width", "height", "n")


def page_image(images: DataFrame, page: list[str], page_width: float, page_height: float, key: str = "image", least: float = 0.3) -> DataFrame:
    """(page, image): the largest picture of a page, if it takes more than `least` of it: the page is that picture, and need not be drawn. Of equal ones
    the first by key. images(page, image, box)."""
    share = area(F.col("box")) / (page_width * page_height)
    rows = images.filter("box IS NOT NULL").select(*page, F.col(key).alias("picture"), share.alias("share")).filter(F.col("share") > least)
    best = rows.groupBy(*page).agg(F.min_by("picture", F.struct((-F.col("share")).alias("s"), "picture")).alias(key))
    return best.select(*page, key)
