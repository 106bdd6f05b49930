"""A Python data source that reads .pptx decks: one row per paragraph, table row, chart series, picture, connector and note, with slide number
and place. Only zip and XML, no office suite.

    spark.dataSource.register(PptxSource)
    spark.read.format("pptx").load("/decks")          # a folder or one file; files are partitions

Files are listed and opened by Python, so the path must be one that Python sees on driver and executors; for decks in an object store, read
them with spark.read.format("binaryFile") and use parsed() on the content.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from pathlib import Path
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
_C = "{http://schemas.openxmlformats.org/drawingml/2006/chart}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_LINK = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"
#: English Metric Units in a point.
EMU = 12_700
NAMES = ["slide_no", "pos", "kind", "form", "level", "text", "x", "y", "width", "height", "hidden"]
FIELDS = "slide_no int, pos int, kind string, form string, level int, text string, x double, y double, width double, height double, hidden boolean"
SCHEMA = f"path string, {FIELDS}"
PARAGRAPH = f"array<struct<{FIELDS.replace(' ', ': ').replace(',:', ',')}>>"
#: Pictures below this share of the slide are marks or logos.
LEAST_PICTURE = 0.03


def _related(z: zipfile.ZipFile, part: str) -> dict[str, str]:
    """A part's links: id to the linked part's name."""
    folder, name = part.rsplit("/", 1)
    links = f"{folder}/_rels/{name}.rels"
    if links not in z.namelist():
        return {}
    target = lambda t: posixpath.normpath(posixpath.join(folder, t)) if not t.startswith("/") else t[1:]
    return {e.get("Id"): target(e.get("Target", "")) for e in ElementTree.fromstring(z.read(links)).iter(_LINK)}


def _text(node) -> str:
    """Runs, fields and line breaks in order, with single spaces."""
    return " ".join("".join(" " if t.tag == f"{_A}br" else t.text or "" for t in node.iter() if t.tag in (f"{_A}t", f"{_A}br")).split())


def _cells(row: list[str]) -> str:
    return "| " + " | ".join(c.replace("|", "\\|") for c in row) + " |"


def _chart(xml: bytes) -> list[str]:
    """A chart's series as the rows of a table: categories first, then each series' name and values."""
    root = ElementTree.fromstring(xml)
    points = lambda node: {int(p.get("idx", 0)): "".join(p.itertext()).strip() for p in node.iter(f"{_C}pt")} if node is not None else {}
    rows, heads = [], {}
    for series in root.iter(f"{_C}ser"):
        name = " ".join(points(series.find(f"{_C}tx")).values())
        category = series.find(f"{_C}cat") if series.find(f"{_C}cat") is not None else series.find(f"{_C}xVal")
        value = series.find(f"{_C}val") if series.find(f"{_C}val") is not None else series.find(f"{_C}yVal")
        heads = heads or points(category)
        rows.append((name, points(value)))
    n = max([0, *(k + 1 for k in heads), *(k + 1 for _, v in rows for k in v)])
    plain = lambda v: f"{float(v):g}" if re.fullmatch(r"-?[0-9.]+(?:[eE][-+]?[0-9]+)?", v) and v.count(".") < 2 else v
    return [_cells(["Series", *(heads.get(k, "") for k in range(n))]), *(_cells([name, *(plain(v.get(k, "")) for k in range(n))]) for name, v in rows)] if rows else []


def _frame(shape, inner: bool, outer):
    """x, y, width, height in points; within a group those of the outermost group, which stands on the slide."""
    if outer:
        return outer
    pair = lambda tag, names: next(([int(e.get(n, 0)) / EMU for n in names] for space in (_A, _P) for e in shape.iter(f"{space}{tag}")), [0.0, 0.0])
    return (*pair("off", ("x", "y")), *pair("ext", ("cx", "cy")))


def _shapes(tree, z: zipfile.ZipFile, links: dict[str, str], area: float, outer=None):
    """(y, x, width, height, kind, form, rows) of the shapes under a tree: kinds title, footer, text, table, chart, picture and connector; the form
    of a text is placeholder, box (a text box), shape (another shape) or group (any of them in a group); rows are (level, text)."""
    for shape in tree:
        x, y, w, h = _frame(shape, outer is not None, outer)
        mark = next(shape.iter(f"{_P}ph"), None)
        role = mark.get("type", "body") if mark is not None else None
        if shape.tag == f"{_P}grpSp":
            yield from _shapes(shape, z, links, area, outer or (x, y, w, h))
        elif shape.tag == f"{_P}cxnSp":
            yield y, x, w, h, "connector", None, [(0, "")]
        elif shape.tag == f"{_P}pic":
            if w * h >= LEAST_PICTURE * area:
                blip = next(shape.iter(f"{_A}blip"), None)
                yield y, x, w, h, "picture", None, [(0, links.get(blip.get(f"{_R}embed"), "") if blip is not None else "")]
        elif shape.tag == f"{_P}graphicFrame":
            chart = next(shape.iter(f"{_C}chart"), None)
            rows = [_cells([" ".join(_text(p) for p in cell.iter(f"{_A}p")).strip() for cell in row.iter(f"{_A}tc")]) for row in shape.iter(f"{_A}tr")]
            if chart is not None:
                part = links.get(chart.get(f"{_R}id"), "")
                yield y, x, w, h, "chart", None, [(0, r) for r in (_chart(z.read(part)) if part in z.namelist() else [])] or [(0, "")]
            elif rows:
                yield y, x, w, h, "table", None, [(0, r) for r in rows]
        elif shape.tag == f"{_P}sp":
            kind = "title" if role in ("title", "ctrTitle") else "footer" if role in ("ftr", "sldNum", "dt") else "text"
            boxed = any(e.get("txBox") == "1" for e in shape.iter(f"{_P}cNvSpPr"))
            form = None if kind != "text" else "group" if outer else "placeholder" if role else "box" if boxed else "shape"
            rows = []
            for p in shape.iter(f"{_A}p"):
                props = p.find(f"{_A}pPr")
                rows.append((int(props.get("lvl", 0)) if props is not None else 0, _text(p)))
            rows = [r for r in rows if r[1]]
            if kind == "title":
                rows = [(0, " ".join(t for _, t in rows))] if rows else []
            if rows:
                yield y, x, w, h, kind, form, rows


def _slides(z: zipfile.ZipFile) -> tuple[list[str], float]:
    """The slides' parts in the deck's order, and a slide's area in square points."""
    numbered = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
    if "ppt/presentation.xml" not in z.namelist():
        return numbered, 720.0 * 540.0
    root, links = ElementTree.fromstring(z.read("ppt/presentation.xml")), _related(z, "ppt/presentation.xml")
    listed = [links.get(e.get(f"{_R}id"), "") for e in root.iter(f"{_P}sldId")]
    size = root.find(f"{_P}sldSz")
    area = int(size.get("cx", 0)) * int(size.get("cy", 0)) / EMU**2 if size is not None else 720.0 * 540.0
    return [n for n in listed if n in z.namelist()] or numbered, area


def paragraphs(content: bytes) -> list[tuple]:
    """(slide_no, pos, kind, form, level, text, x, y, width, height, hidden) of all paragraphs, table and chart rows, pictures and connectors, shapes
    from top to bottom and left to right; a slide's notes stand last."""
    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        slides, area = _slides(z)
        for number, name in enumerate(slides, 1):
            root, links = ElementTree.fromstring(z.read(name)), _related(z, name)
            shapes = [s for tree in root.iter(f"{_P}spTree") for s in _shapes(tree, z, links, area)]
            shapes.sort(key=lambda s: s[:2])
            rows = [(kind, form, level, text, x, y, w, h) for y, x, w, h, kind, form, told in shapes for level, text in told]
            notes = next((n for n in links.values() if n.startswith("ppt/notesSlides/") and n in z.namelist()), None)
            if notes:
                page = ElementTree.fromstring(z.read(notes))
                bodies = [s for s in page.iter(f"{_P}sp") if any(p.get("type") == "body" for p in s.iter(f"{_P}ph"))]
                rows += [("notes", None, 0, t, 0.0, 0.0, 0.0, 0.0) for s in bodies for t in map(_text, s.iter(f"{_A}p")) if t]
            out += [(number, i, *r, root.get("show") == "0") for i, r in enumerate(rows)]
    return out


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root = Path(options["path"].removeprefix("file://"))

    def partitions(self):
        found = [self.root] if self.root.is_file() else sorted(p for p in self.root.rglob("*.pptx") if not p.name.startswith(("~$", ".")))
        return [_File(str(p)) for p in found]

    def read(self, partition):
        for row in paragraphs(Path(partition.path).read_bytes()):
            yield (partition.path, *row)


class PptxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pptx"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


#: Files that a Python worker has open at a time.
AT_A_TIME = 32


def slices(batches, most: int = AT_A_TIME):
    """Record batches cut into ones of `most` rows: a batch of Spark's may hold thousands of files, and what is made of each is larger than the file."""
    for b in batches:
        for at in range(0, b.num_rows, most):
            yield b.slice(at, most)


def parsed(files: DataFrame, content: str = "content") -> DataFrame:
    """The same rows from binaryFile's content, and error for a deck that cannot be read (its other columns are null)."""

    def read(contents: pa.Array) -> list[pa.Array]:
        rows, errors = [], []
        for c in contents:
            try:
                rows.append([dict(zip(NAMES, r, strict=True)) for r in paragraphs(c.as_py())])
                errors.append(None)
            except (zipfile.BadZipFile, ElementTree.ParseError, TypeError, ValueError, KeyError) as e:  # one bad file must not stop the others
                rows.append([])
                errors.append(f"{type(e).__name__}: {e}"[:200])
        types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
        kind = pa.list_(pa.struct(list(zip(NAMES, types, strict=True))))
        return [pa.array(rows, kind), pa.array(errors, pa.string())]

    def opened(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), *read(b.column(1))], names=["path", "rows", "error"])

    read_ = files.select("path", F.col(content).alias("content")).mapInArrow(opened, f"path {files.schema['path'].dataType.simpleString()}, rows {PARAGRAPH}, error string")
    return read_.select("path", "error", F.explode_outer("rows").alias("p")).select("path", "error", "p.*")


def slides(rows: DataFrame) -> DataFrame:
    """(path, slide_no, hidden, title, flags, labels, items, notes) from the rows of paragraphs: one row a slide.

    A slide is a diagram if it has connectors, text in groups, or three shapes with text: then those texts are labels, else they are listed. items: array<struct<kind, level, text>> with kinds item, paragraph and table; flags say what only a picture shows.
    """
    order, k = F.struct("pos", "kind", "form", "level", "text"), F.col("kind")
    shape = F.coalesce(F.col("form") == "shape", F.lit(False))
    per = rows.filter("slide_no IS NOT NULL").groupBy("path", "slide_no").agg(
        F.bool_or("hidden").alias("hidden"), F.array_sort(F.collect_list(order)).alias("r"),
        (F.bool_or((k == "connector") | F.coalesce(F.col("form") == "group", F.lit(False))) | (F.countDistinct(F.when(shape, F.struct("x", "y"))) >= 3)).alias("diagram"),
        F.count(F.when(shape, 1)).alias("shapes"), F.bool_or(shape & (F.col("level") > 0)).alias("deep"))
    of = lambda *kinds: F.filter("r", lambda x: x["kind"].isin(*kinds))
    drawn = F.filter("r", lambda x: F.coalesce(x["form"].isin("group", "shape"), F.lit(False)))
    texts = lambda c: F.transform(c, lambda x: x["text"])
    title = F.array_join(texts(of("title")), " ")
    schematic = F.col("diagram") & (F.size(drawn) > 0)
    listed = F.filter("r", lambda x: F.coalesce(x["form"].isin("placeholder", "box"), x["kind"] == "table") | ((x["kind"] == "chart") & (x["text"] != "")) | (F.coalesce(x["form"] == "shape", F.lit(False)) & ~F.col("diagram")))
    bulleted = (F.col("shapes") > 1) | F.col("deep")
    kind = lambda x: F.when(x["kind"].isin("table", "chart"), "table").when((x["form"] == "placeholder") | ((x["form"] == "shape") & bulleted), "item").otherwise("paragraph")
    items = F.transform(listed, lambda x: F.struct(kind(x).alias("kind"), x["level"].alias("level"), x["text"].alias("text")))
    flags = F.array_compact(F.array(
        F.when(F.size(of("chart")) > 0, F.when(F.exists(of("chart"), lambda x: x["text"] == ""), "chart (values not read, see the picture)").otherwise("chart (values read from the deck)")),
        F.when(schematic, "diagram (arrows and relations are in the picture)"), F.when(F.size(of("picture")) > 0, "picture (see it)"), F.when(title == "", "no title")))
    labels = F.when(schematic, texts(drawn)).otherwise(F.array().cast("array<string>"))
    return per.select("path", "slide_no", "hidden", title.alias("title"), flags.alias("flags"), labels.alias("labels"), items.alias("items"), F.array_join(texts(of("notes")), "\n").alias("notes"))
