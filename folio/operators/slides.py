"""Slide decks: one-dimensional clusters, bullets, labels, titles, tables, markdown.

Edge cases: null values are in no cluster and no median; boxes that are null, and lines of a null page or deck, meet no other; a null text is
an empty label and no title; ties go to the smaller place; repeated lines count as often as they stand; an empty table gives no rows. Work is by
slide (some dozens of lines) or by distinct values of a deck.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.geometry import same_level
from folio.functions.text import escape_block, join_lines, normal_line, squeeze, table_cell
from folio.plans.runtime import same_keys


def clusters_1d(df: DataFrame, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """(keys, cluster, centre, n): sorted values, a new cluster where the step exceeds the tolerance. Equal values are summed before the window."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*keys).orderBy(value)
    step = F.when(F.col(value) - F.lag(value).over(w) <= tolerance, 0).otherwise(1)
    numbered = counts.withColumn("step", step).withColumn("cluster", F.sum("step").over(w).cast("int"))
    return numbered.groupBy(*keys, "cluster").agg((F.sum(F.col(value) * F.col("c")) / F.sum("c")).alias("centre"), F.sum("c").alias("n"))


def upper_median(df: DataFrame, keys: list[str], value: str, part: int = 2) -> DataFrame:
    """The value at place n div part of the sorted values (from 0), never interpolated: part 2 the upper median, 4 the lower quartile.

    From counts of distinct values and their running sum, so that a key with very many rows is summed before it meets in one window.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*keys).orderBy(value))
    total = F.sum("c").over(Window.partitionBy(*keys))
    place = F.floor(total / part)
    return counts.withColumn("upto", upto).withColumn("place", place).filter("upto > place AND upto - c <= place").select(*keys, F.col(value).alias("median"))


def bullet_levels(lines_: DataFrame, deck: list[str], tolerance: float = 10.0) -> DataFrame:
    """Adds level to lines with a bullet: the nearest centre of the bullets' indents, from the left; clusters with fewer than
    max(2, 1 %) bullets count only if there are no others."""
    marks = lines_.filter("bullet_x IS NOT NULL")
    groups = clusters_1d(marks, deck, "bullet_x", tolerance)
    total = F.sum("n").over(Window.partitionBy(*deck))
    big = groups.withColumn("big", F.col("n") >= F.greatest(F.lit(2.0), total * 0.01)).withColumn("any_big", F.max("big").over(Window.partitionBy(*deck)))
    centres = big.filter("big OR NOT any_big").groupBy(*deck).agg(F.array_sort(F.collect_list("centre")).alias("centres"))
    at = F.transform("centres", lambda c, i: F.struct(F.abs(c - F.col("bullet_x")).alias("d"), i.alias("i")))
    joined = lines_.join(centres, deck, "left")
    return joined.withColumn("level", F.when(F.col("bullet_x").isNotNull(), F.array_min(at)["i"])).drop("centres")


def matched_bullets(lines_: DataFrame, marks: DataFrame, page: list[str]) -> DataFrame:
    """(page, mark, pos): each bullet glyph takes the nearest line to its right (90 points) at its height, no line twice.

    marks(page, mark, x, yc). Pairs come from a join by page and range; a page's pairs are one row in the order of choice, and batches of pages are decided together.
    """
    b = F.col("box")
    h = b["y1"] - b["y0"]
    near = marks.join(lines_.select(*page, "pos", "box"), page).filter((b["x0"] > F.col("x")) & (b["x0"] - F.col("x") < 90) & (F.col("yc") >= b["y0"] - 0.3 * h) & (F.col("yc") <= b["y1"] + 0.3 * h))
    off = F.abs((b["y0"] + b["y1"]) / 2 - F.col("yc"))
    ranked = near.select(*page, "mark", "pos", (off > 0.6 * h).alias("far"), (b["x0"] - F.col("x")).alias("dx"), off.alias("dy"))

    kinds = {c: ranked.schema[c].dataType.simpleString() for c in ("mark", "pos")}

    @F.arrow_udf(f"array<struct<mark:{kinds['mark']},pos:{kinds['pos']}>>")
    def choose(pages: pa.Array) -> pa.Array:
        flat, kept, ends, at = pages.flatten(), [], [0], 0
        marks, places = (flat.field(flat.type.get_field_index(c)) for c in ("mark", "pos"))
        told = list(zip(marks.to_pylist(), places.to_pylist(), strict=True))
        for n in pages.value_lengths().to_pylist():
            of_mark, of_place = set(), set()
            for i in range(at, at + n):
                mark, place = told[i]
                if mark in of_mark or place in of_place:
                    continue
                of_mark |= {mark} - {None}
                of_place |= {place} - {None}
                kept.append(i)
            at += n
            ends.append(len(kept))
        kept = pa.array(kept, pa.int64())
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([marks.take(kept), places.take(kept)], ["mark", "pos"]))

    whole = ranked.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("mark", "far", "dx", "dy", "pos"))).alias("near"))
    return whole.select(*page, F.explode(choose(F.col("near"))).alias("m")).select(*page, "m.mark", "m.pos")


def repeated_lines(lines_: DataFrame, deck: list[str], slide: str = "page_idx") -> DataFrame:
    """Normalised lines in the top 8 % or bottom 12 % of at least max(2, half) of a deck's slides; lines_(deck, slide, text, y, height)."""
    edge = (F.col("y") > 0.88 * F.col("height")) | (F.col("y") < 0.08 * F.col("height"))
    key = F.regexp_replace(normal_line(F.col("text")), r"\s+", " ")
    seen = lines_.filter(edge).select(*deck, slide, key.alias("footer")).filter("footer <> ''").distinct().groupBy(*deck, "footer").agg(F.count(F.lit(1)).alias("n_slides"))
    sizes = lines_.groupBy(*deck).agg(F.countDistinct(slide).alias("slides"))
    return seen.join(sizes, deck).filter(F.col("n_slides") >= F.greatest(F.lit(2), F.floor(F.col("slides") / 2))).select(*deck, "footer", "n_slides")


def visual_rows(lines_: DataFrame, page: list[str]) -> DataFrame:
    """Adds row_no: lines at one height (top edges within 3 points, or more than half overlapping the row's first line) are one row."""
    rows = lines_.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct(F.col("box")["y0"].alias("y"), F.col("box")["x0"].alias("x"), "pos", "box", "text"))).alias("rows"))
    kind = rows.schema["rows"].dataType.elementType.simpleString()
    start = F.struct(F.array().cast(f"array<struct<row_no:int,line:{kind}>>").alias("out"), F.lit(-1).alias("n"), F.lit(None).cast("struct<x0:double,y0:double,x1:double,y1:double>").alias("first"))

    def step(acc, r):
        same = acc["first"].isNotNull() & F.coalesce((F.abs(acc["first"]["y0"] - r["box"]["y0"]) < 3) | same_level(acc["first"], r["box"]), F.lit(False))
        n = acc["n"] + F.when(same, 0).otherwise(1)
        return F.struct(F.array_append(acc["out"], F.struct(n.alias("row_no"), r.alias("line"))).alias("out"), n.alias("n"), F.when(same, acc["first"]).otherwise(r["box"]).alias("first"))

    # a fold over one slide's lines
    return rows.select(*page, F.explode(F.aggregate("rows", start, step, lambda a: a["out"])).alias("r")).select(*page, "r.row_no", "r.line.pos", "r.line.box", "r.line.text")


def slide_tables(lines_: DataFrame, page: list[str], tolerance: float = 15.0) -> DataFrame:
    """(page, row_no, cells): the table that a slide's lines without bullets make: see table_rows."""
    return table_rows(lines_, page, tolerance).select(*page, "row_no", "cells")


def table_rows(lines_: DataFrame, page: list[str], tolerance: float = 15.0) -> DataFrame:
    """(page, row_no, cells, places, top): the table that a slide's lines without bullets make: three rows at least with two columns or more, set apart by
    8 points; places are the pos of the lines that a row is made of, top is where the table begins.

    Columns are the clusters of those rows' left edges; what stands in one of them from the first such row on is the table. A line of it begins a new row
    by what stands in the first column: nothing there goes on with the row above; something does begin one if the line above has nothing there, or if all
    lines have something there and are evenly set (no step of 1.3 times the lower quartile of the steps); else if the step above it is wider than that.
    A slide's lines are one row; a batch of slides is decided in one call, and only the texts of a cell are joined by Spark.
    """
    plain = lines_.filter("bullet_x IS NULL") if "bullet_x" in lines_.columns else lines_
    b = F.col("box")
    line = F.struct(b["y0"].alias("y0"), b["x0"].alias("x0"), "pos", b.isNull().alias("none"), b["x1"].alias("x1"), b["y1"].alias("y1"), "text")
    whole = plain.dropna(subset=page).groupBy(*page).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    found = whole.select(*page, F.explode(_tables(plain.schema["pos"].dataType.simpleString(), tolerance)(F.col("lines"))).alias("r"))
    cell = lambda texts: F.aggregate(texts, F.lit(""), lambda told, t: join_lines(told, F.coalesce(t, F.lit(""))))
    return found.select(*page, "r.row_no", F.transform("r.cells", cell).alias("cells"), "r.places", "r.top")


def _least(a: float | None, b: float | None) -> float | None:
    return b if a is None else a if b is None or a <= b else b


def _most(a: float | None, b: float | None) -> float | None:
    return b if a is None else a if b is None or a >= b else b


def _less(a: float | None, b: float | None) -> float | None:
    return None if a is None or b is None else a - b


def _rows_of(boxes: list, lines_: list[int]) -> list[list[int]]:
    """visual_rows of one slide's lines, which come in order."""
    rows, first = [], None
    for i in lines_:
        box, same = boxes[i], False
        if first is not None and box is not None:
            step = _less(first[1], box[1])
            same = step is not None and abs(step) < 3
            if not same:
                over = _less(_least(first[3], box[3]), _most(first[1], box[1]))
                same = over is not None and over > 0.5 * _most(1.0, _least(_less(first[3], first[1]), _less(box[3], box[1])))
        if same:
            rows[-1].append(i)
        else:
            rows.append([i])
            first = box
    return rows


def _table(boxes: list, pos: list, texts: list, begin: int, end: int, tolerance: float) -> tuple[list[list[tuple[int, int]]], int, float] | None:
    """One slide's table: its rows of (column, line), how many columns it has, and where it begins."""
    wide, top = [], None
    for row in _rows_of(boxes, range(begin, end)):
        if len(row) < 2:
            continue
        held = sorted((boxes[i] or (None,) * 4 for i in row), key=lambda x: (x[0] is not None, x[0] or 0.0))
        gaps = (_less(after[0], box[2]) for box, after in zip(held, held[1:], strict=False))
        if all(g is None or g > 8 for g in gaps):
            if not wide:
                top = min((x[1] for x in held if x[1] is not None), default=None)
            wide.append([x[0] for x in held if x[0] is not None])
    if len(wide) < 3 or top is None:
        return None
    top, counts = top - 2, {}
    for x in (x for row in wide for x in row):
        counts[x] = counts.get(x, 0) + 1
    columns, before = [], None
    for x in sorted(counts):
        if before is None or not x - before <= tolerance:
            columns.append([0.0, 0])
        columns[-1][0] += x * counts[x]
        columns[-1][1] += counts[x]
        before = x
    if len(columns) < 2:
        return None
    centres = sorted(total / n for total, n in columns)
    place = {}
    for i in range(begin, end):
        box = boxes[i]
        if box is not None and box[0] is not None and box[1] is not None and box[1] >= top:
            far, k = min((abs(c - box[0]), k) for k, c in enumerate(centres))
            if far < tolerance:
                place[i] = k
    levels = _rows_of(boxes, list(place))
    if not levels:
        return None
    starts, first = [boxes[row[0]][1] for row in levels], [any(place[i] == 0 for i in row) for row in levels]
    steps = sorted(b - a for a, b in zip(starts, starts[1:], strict=False))
    usual = steps[len(steps) // 4] if steps else None
    even = all(first) and bool(steps) and steps[-1] < 1.3 * usual
    rows = []
    for n, row in enumerate(levels):
        if n == 0 or (first[n] and (even or not first[n - 1] or starts[n] - starts[n - 1] > 1.3 * usual)):
            rows.append([])
        # lines of one place by their text
        told = sorted(row, key=lambda i: (texts[i] is not None, (texts[i] or "").encode())) if len({(boxes[i][:2], pos[i]) for i in row}) < len(row) else None
        if told:
            where = {}
            for i in row:
                where.setdefault((boxes[i][:2], pos[i]), len(where))
            row = sorted(told, key=lambda i: where[boxes[i][:2], pos[i]])
        rows[-1] += [(place[i], i) for i in row]
    return (rows, len(centres), top) if len(rows) >= 3 else None


def _tables(pos: str, tolerance: float):
    @F.arrow_udf(f"array<struct<row_no:int,cells:array<array<string>>,places:array<{pos}>,top:double>>")
    def tables(slides: pa.Array) -> pa.Array:
        flat = slides.flatten()
        of = {flat.type.field(i).name: flat.field(i) for i in range(flat.type.num_fields)}
        edges = zip(*[of[c].to_pylist() for c in ("none", "x0", "y0", "x1", "y1")], strict=True)
        boxes, texts, places = [None if none else tuple(box) for none, *box in edges], of["text"].to_pylist(), of["pos"].to_pylist()
        numbers, tops, ends, at = [], [], [0], 0
        row_ends, cell_ends, cell_lines, line_ends, lines_ = [0], [0], [], [0], []
        for n in slides.value_lengths().to_pylist():
            found = _table(boxes, places, texts, at, at + n, tolerance)
            at += n
            if found:
                rows, n_columns, top = found
                for number, row in enumerate(rows, 1):
                    numbers.append(number)
                    tops.append(top)
                    cells = [[] for _ in range(n_columns)]
                    for k, i in row:
                        cells[k].append(i)
                        lines_.append(i)
                    line_ends.append(len(lines_))
                    for c in cells:
                        cell_lines += c
                        cell_ends.append(len(cell_lines))
                    row_ends.append(len(cell_ends) - 1)
            ends.append(len(numbers))
        listed = lambda bounds, values: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
        cells = listed(row_ends, listed(cell_ends, of["text"].take(pa.array(cell_lines, pa.int64()))))
        told = {"row_no": pa.array(numbers, pa.int32()), "cells": cells, "places": listed(line_ends, of["pos"].take(pa.array(lines_, pa.int64()))), "top": pa.array(tops, pa.float64())}
        return listed(ends, pa.StructArray.from_arrays(list(told.values()), list(told)))

    return tables


def deck_titles(slides: DataFrame, rendered: DataFrame, deck: list[str]) -> DataFrame:
    """Missing titles filled from the rendered pages of the same number; the same text leaves the body items."""
    r = rendered.select(*deck, F.col("slide_no"), F.col("title").alias("rendered_title"))
    joined = slides.join(r, [*deck, "slide_no"], "left")
    title = F.coalesce(F.when(F.trim("title") != "", F.col("title")), F.col("rendered_title"))
    filled = F.coalesce(F.trim("title"), F.lit("")) == ""
    items = F.when(filled, F.filter("items", lambda i: F.coalesce(squeeze(i) != squeeze(F.col("rendered_title")), F.lit(True)))).otherwise(F.col("items"))
    return joined.select(*deck, "slide_no", title.alias("title"), items.alias("items"))


def visible_match(slides: DataFrame, pages: DataFrame, deck: list[str]) -> DataFrame:
    """Slides paired with rendered pages: by number if there are as many pages as slides, by rank among visible ones if as many as those."""
    w = Window.partitionBy(*deck)
    counted = slides.withColumn("all_slides", F.count(F.lit(1)).over(w)).withColumn("shown_slides", F.sum((~F.col("hidden")).cast("int")).over(w)).withColumn("shown_no", F.sum((~F.col("hidden")).cast("int")).over(w.orderBy("slide_no")))
    n = pages.groupBy(*deck).agg(F.count(F.lit(1)).alias("n_pages"))
    number = F.when(F.col("n_pages") == F.col("all_slides"), F.col("slide_no")).when((F.col("n_pages") == F.col("shown_slides")) & ~F.col("hidden"), F.col("shown_no"))
    return counted.join(n, deck).select(*deck, "slide_no", number.cast("int").alias("page_no")).filter("page_no IS NOT NULL")


def slide_markdown(title: Column, items: Column, notes: Column) -> Column:
    """items: array<struct<kind, level, text>>."""
    line = F.transform(items, lambda i: F.when(i["kind"] == "item", F.concat(F.repeat(F.lit("  "), i["level"]), F.lit("- "), squeeze(i["text"]))).when(i["kind"] == "heading", F.concat(F.lit("### "), squeeze(i["text"]))).otherwise(escape_block(squeeze(i["text"]))))
    return F.concat_ws("\n\n", F.concat(F.lit("## "), title), F.array_join(line, "\n"), F.when(F.coalesce(notes, F.lit("")) != "", F.concat(F.lit("> "), notes)))


def table_rows_markdown(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.transform(cells, table_cell), " | "), F.lit(" |"))


def label_groups(lines_: DataFrame, page: list[str]) -> DataFrame:
    """(page, no, label): lines stacked under each other, centres less than 20 points apart and gaps under 0.7 of their height, are one label.

    From the top, each line goes on with the first label whose last line it stands under. Labels are read in rows (tops within 0.6 of a label's first
    line's height), from the left. A fold over one slide's lines: what a line may go on with depends on the lines before it.
    """
    b = F.col("box")
    line = F.struct(b["y0"].alias("y0"), b["x0"].alias("x0"), "pos", b["y1"].alias("y1"), ((b["x0"] + b["x1"]) / 2).alias("centre"), F.coalesce("text", F.lit("")).alias("text"))
    rows = lines_.filter("box IS NOT NULL").groupBy(*page).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    label = "struct<top:double,left:double,height:double,centre:double,bottom:double,text:string>"

    def begun(r):
        return F.struct(r["y0"].alias("top"), r["x0"].alias("left"), (r["y1"] - r["y0"]).alias("height"), r["centre"].alias("centre"), r["y1"].alias("bottom"), join_lines(F.lit(""), r["text"]).alias("text"))

    def step(labels, r):
        under = lambda g: (F.abs(g["centre"] - r["centre"]) < 20) & (r["y0"] >= g["bottom"]) & (r["y0"] - g["bottom"] < 0.7 * (r["y1"] - r["y0"]))
        at = F.array_position(F.transform(labels, under), F.lit(True)) - 1
        longer = lambda g: F.struct(g["top"].alias("top"), g["left"].alias("left"), g["height"].alias("height"), r["centre"].alias("centre"), r["y1"].alias("bottom"), join_lines(g["text"], r["text"]).alias("text"))
        return F.when(at >= 0, F.transform(labels, lambda g, i: F.when(i == at, longer(g)).otherwise(g))).otherwise(F.array_append(labels, begun(r)))

    grouped = rows.select(*page, F.aggregate("lines", F.array().cast(f"array<{label}>"), step).alias("labels"))
    start = F.struct(F.lit(0).alias("row"), F.lit(None).cast("double").alias("top"), F.array().cast(f"array<struct<row:int,left:double,no:int,text:string>>").alias("out"))

    def place(acc, g):
        same = F.coalesce(F.abs(g["top"] - acc["top"]) < 0.6 * F.greatest(g["height"], F.lit(1.0)), F.lit(False))
        row = acc["row"] + F.when(same, 0).otherwise(1)
        return F.struct(row.alias("row"), F.when(same, acc["top"]).otherwise(g["top"]).alias("top"), F.array_append(acc["out"], F.struct(row.alias("row"), g["left"].alias("left"), F.size(acc["out"]).alias("no"), g["text"].alias("text"))).alias("out"))

    # labels are in the order of their tops, as they began
    read = grouped.select(*page, F.posexplode(F.array_sort(F.aggregate("labels", start, place, lambda acc: acc["out"]))).alias("no", "label"))
    return read.select(*page, (F.col("no") + 1).alias("no"), "label.text").withColumnRenamed("text", "label")


def structured(lines_: DataFrame, deck: list[str], slide: str = "page_idx", page_height: float = 540.0) -> DataFrame:
    """Adds role: title (the largest text in the top 28 %, 1.15 times the slide's upper median size or more), item (with a bullet) or paragraph."""
    page = [*deck, slide]
    size = F.col("box")["y1"] - F.col("box")["y0"]
    sized = lines_.withColumn("size", size)
    median = upper_median(sized, page, "size").withColumnRenamed("median", "median_size")
    top = F.col("box")["y0"] < 0.28 * page_height
    rank = F.row_number().over(Window.partitionBy(*page).orderBy(F.desc(F.when(top, F.col("size"))), F.col("box")["y0"], "pos"))
    ranked = sized.join(median, page).withColumn("rank", rank)
    role = F.when((F.col("rank") == 1) & top & (F.col("size") >= 1.15 * F.col("median_size")) & F.col("bullet_x").isNull(), "title").when(F.col("bullet_x").isNotNull(), "item").otherwise("paragraph")
    return ranked.withColumn("role", role).drop("rank", "median_size", "size")


def drop_caps(spans: DataFrame, page: list[str], body_size: float) -> DataFrame:
    """(page, capital, pos): single capitals over twice the body size with a line in small letters to their right at their height."""
    b = F.col("box")
    caps = spans.filter(F.trim("text").rlike(r"^\p{Lu}$") & (F.col("size") > 2 * body_size)).select(*page, F.trim("text").alias("capital"), F.col("box").alias("cap_box"))
    c = F.col("cap_box")
    near = spans.join(caps, page).filter(F.ltrim("text").rlike(r"^\p{Ll}") & (b["x0"] >= c["x1"] - 2) & (b["x0"] - c["x1"] < 20) & (b["y0"] < c["y1"]) & (b["y1"] > c["y0"]))
    return near.groupBy(*page, "capital").agg(F.min_by("pos", F.struct(b["y0"], b["x0"])).alias("pos"))


def drop_caps_placed(pages: DataFrame, spans: DataFrame, page: list[str], body_size: float, text: str = "text") -> DataFrame:
    """The pages' texts with their large initials put before the words that stand beside them (the first three of that line, where they first occur);
    a text without these words stays."""
    caps = drop_caps(spans, page, body_size)
    words = F.regexp_extract_all("beside", F.lit(r"(\S+)"), F.lit(1))
    beside = same_keys(caps, spans.select(*page, "pos", F.col("text").alias("beside")), [*page, "pos"]).select(*page, F.struct("pos", "capital", F.slice(words, 1, 3).alias("words")).alias("c"))
    found = beside.groupBy(*page).agg(F.array_sort(F.collect_set("c")).alias("initials"))  # of one page
    literal = lambda w: F.concat(F.lit(r"\Q"), F.replace(w, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))

    def put(told, c):
        at = F.regexp_instr(told, F.concat(F.lit(r"(?<!\w)"), F.array_join(F.transform(c["words"], literal), r"\s+")))
        return F.when(at > 0, F.concat(F.substring(told, F.lit(1), at - 1), c["capital"], F.substring(told, at, F.length(told)))).otherwise(told)

    rows = same_keys(pages, found, page, "left")
    placed = F.when(F.col("initials").isNull(), F.col(text)).otherwise(F.aggregate("initials", F.col(text), put))
    return rows.select(*[placed.alias(c) if c == text else F.col(f"`{c}`") for c in pages.columns])


def slide_middle(lines_: DataFrame, page: list[str]) -> DataFrame:
    """(page, middle): halfway between the left edge at place n div 10 and the right edge at that place from the right: buttons at the
    margins do not count."""
    b = F.col("box")
    rows = lines_.groupBy(*page).agg(F.array_sort(F.collect_list(b["x0"])).alias("l"), F.array_sort(F.collect_list(b["x1"])).alias("r"))  # of one slide
    place = F.floor(F.size("l") / 10).cast("int")
    return rows.select(*page, ((F.get("l", place) + F.get("r", F.size("r") - 1 - place)) / 2).alias("middle"))


def visual_regions(objects: DataFrame, page_width: float, page_height: float) -> DataFrame:
    """Objects (kind raster or drawing, box) that may be figures: rasters of 2 to 90 % of the slide; drawings up to 80 % that are no rule across
    it and no dot, with kind line for thin ones."""
    b = F.col("box")
    w, h, share = b["x1"] - b["x0"], b["y1"] - b["y0"], (b["x1"] - b["x0"]) * (b["y1"] - b["y0"]) / (page_width * page_height)
    raster_ = (F.col("kind") == "raster") & (share >= 0.02) & (share < 0.9)
    drawing = (F.col("kind") == "drawing") & (share <= 0.8) & ~((h < 4) & (w > 0.4 * page_width)) & ~((w < 4) & (h < 4))
    return objects.filter(raster_ | drawing).withColumn("kind", F.when(F.col("kind") == "raster", "raster").when((h < 4) | (w < 4), "line").otherwise("shape"))


#: How OCR reads a bullet.
READ_AS_BULLET = ["e", "«", "¢", "¢«", "+", "*", "•", "●", "o", "°", "-", "–", "»", "©", "@", "®", "«e", "ee"]


def read_bullets(words: DataFrame, line: list[str]) -> DataFrame:
    """(line, bullet_x, text, x0): lines whose first word is a bullet that OCR took for a sign: one or two signs set apart by half the line's height, or a
    known misreading, before a word with a capital or a digit; text and x0 are what follows. words(line, box, text), in order from the left."""
    b = F.col("box")
    ordered = F.array_sort(F.collect_list(F.struct(b["x0"].alias("x0"), b["x1"].alias("x1"), F.col("text").alias("text"))))
    rows = words.groupBy(*line).agg(ordered.alias("w"), (F.max(b["y1"]) - F.min(b["y0"])).alias("h")).filter(F.size("w") >= 2)  # of one line
    first, second = F.element_at("w", 1), F.element_at("w", 2)
    known = first["text"].isin(READ_AS_BULLET)
    sign = (F.length(first["text"]) <= 2) & ~first["text"].rlike(r"[\p{L}\p{N}]")
    apart = second["x0"] - first["x1"] >= 0.5 * F.greatest(F.lit(8.0), F.col("h"))
    hit = (known | (sign & apart)) & second["text"].rlike(r"^[\p{Lu}\p{N}]")
    rest = F.transform(F.slice("w", F.lit(2), F.size("w")), lambda x: x["text"])
    return rows.filter(hit).select(*line, first["x0"].alias("bullet_x"), F.array_join(rest, " ").alias("text"), second["x0"].alias("x0"))


def blob_bullets(lines_: DataFrame, ink: DataFrame, page: list[str], line: str = "line_no", cell: float = 2.0) -> DataFrame:
    """(page, line, bullet_x): lines with one small dark blob to their left, and nothing else there: the search goes from 4.5 to 0.3 line heights left
    of the text, at its middle; the blob is at most 0.8 heights wide and high, and ends 0.2 heights before the strip does.
    lines_(page, line, box), ink(page, gx, gy) of dark cells."""
    b = F.col("box")
    h = F.greatest(F.lit(8.0), b["y1"] - b["y0"])
    x, y = F.col("gx") * cell, F.col("gy") * cell
    middle = (b["y0"] + b["y1"]) / 2
    left, right = F.greatest(F.lit(0.0), b["x0"] - 4.5 * h), F.greatest(F.lit(0.0), b["x0"] - 0.3 * h)
    beside = lines_.select(*page, line, "box").join(ink.select(*page, "gx", "gy").distinct(), page).filter((x >= left) & (x < right) & (y >= middle - 0.5 * h) & (y < middle + 0.5 * h))
    columns = beside.groupBy(*page, line, "box", "gx").agg(F.collect_set("gy").alias("rows"))  # of one strip
    blobs = columns.groupBy(*page, line, "box").agg(F.min("gx").alias("a"), F.max("gx").alias("z"), F.count(F.lit(1)).alias("n"), F.size(F.array_distinct(F.flatten(F.collect_list("rows")))).alias("high"))
    one = (F.col("z") - F.col("a") + 1 == F.col("n")) & (F.col("n") * cell <= 0.8 * h) & (F.col("high") * cell <= 0.8 * h) & (right - (F.col("z") + 1) * cell >= 0.2 * h)
    return blobs.filter(one).select(*page, line, (F.col("a") * cell).alias("bullet_x"))


def image_slides(lines_: DataFrame, page: list[str]) -> DataFrame:
    """(page, slide, pos, role, level, text): the lines of image-only pages as slides: parted after repeated footers, which go; the tallest line of
    a slide, if in its top 28 % and 1.15 times the upper median, is the title; lines with a bullet are items at the level of their indent.

    lines_(page, pos, box, text, confidence, bullet_x), the page's last key its number in the book.
    """
    from folio.operators.ocr import slide_bands

    b = F.col("box")
    banded = slide_bands(lines_.withColumn("y0", b["y0"]), page).filter("NOT is_footer")
    whole = [*page, "slide"]
    height = b["y1"] - b["y0"]
    sized = banded.withColumn("h", height)
    median = upper_median(sized, whole, "h").withColumnRenamed("median", "median_h")
    w = Window.partitionBy(*whole)
    top, bottom = F.min(b["y0"]).over(w), F.max(b["y1"]).over(w)
    placed = sized.withColumn("top", top).withColumn("span", bottom - top).join(median, whole)
    high = (b["y0"] - F.col("top") <= 0.28 * F.col("span")) & F.col("bullet_x").isNull() & (F.coalesce("confidence", F.lit(100.0)) >= 80)
    rank = F.row_number().over(w.orderBy(F.desc(F.when(high, F.col("h"))), b["y0"], "pos"))
    title = (rank == 1) & high & (F.col("h") >= 1.15 * F.col("median_h"))
    role = F.when(title, "title").when(F.col("bullet_x").isNotNull(), "item").otherwise("paragraph")
    levels = bullet_levels(placed.withColumn("role", role), page[:-1])
    return levels.select(*whole, "pos", "role", "level", "text")


def reread(bands: DataFrame, words_before: DataFrame, words_after: DataFrame, band: list[str], page_height: float) -> DataFrame:
    """(band, again): which reading of a band counts: bands(band, top, bottom) of a fifth of the page or more with fewer than eight words are read again,
    and the new reading (words_after) is taken if it has more words. Words are rows with the band's key."""
    n = lambda df, name: df.groupBy(*band).agg(F.count(F.lit(1)).alias(name))
    rows = same_keys(same_keys(bands, n(words_before, "before"), band, "left"), n(words_after, "after"), band, "left").fillna(0, ["before", "after"])
    return rows.select(*band, ((F.col("bottom") - F.col("top") >= 0.2 * page_height) & (F.col("before") < 8) & (F.col("after") > F.col("before"))).alias("again"))


def best_structure(readings: DataFrame, page: list[str]) -> DataFrame:
    """(page, reading): of several readings the one with a table (three rows, three quarters of the cells filled), then with more words, then the surer,
    then the first. readings(page, reading, n_rows, n_cells, n_filled, n_words, confidence)."""
    table = (F.col("n_rows") >= 3) & (F.col("n_filled") >= 0.75 * F.col("n_cells"))
    best = F.max_by("reading", F.struct(F.coalesce(table, F.lit(False)).alias("t"), "n_words", "confidence", (-F.col("reading")).alias("r")))
    return readings.groupBy(*page).agg(best.alias("reading"))


def without_repeats(lines_: DataFrame, deck: list[str], slide: str = "page_idx", page_height: float = 540.0) -> tuple[DataFrame, DataFrame]:
    """The lines but for those that repeat at the edges of a deck's slides, and (deck, removed), up to five of these. lines_(deck, slide, pos, box, text, bullet_x)."""
    key = F.regexp_replace(normal_line(F.col("text")), r"\s+", " ")
    y = F.col("box")["y0"]
    edged = lines_.withColumn("y", y).withColumn("height", F.lit(page_height)).withColumn("footer", key)
    footers = repeated_lines(edged, deck, slide)
    at_edge = (F.col("y") > 0.88 * page_height) | (F.col("y") < 0.08 * page_height)
    marked = same_keys(edged, footers.select(*deck, "footer", F.lit(True).alias("repeats")), [*deck, "footer"], "left").withColumn("gone", F.coalesce(F.col("repeats"), F.lit(False)) & at_edge)
    first = marked.filter("gone").groupBy(*deck, "footer").agg(F.min_by("text", F.struct(slide, "pos")).alias("text"), F.min(F.struct(slide, "pos")).alias("at"))
    shown = first.groupBy(*deck).agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("at", "text"))), 1, 5), lambda x: x["text"]).alias("removed"))
    return marked.filter("NOT gone").select(*deck, slide, "pos", "box", "text", "bullet_x"), shown


def text_slides(lines_: DataFrame, deck: list[str], slide: str = "page_idx", page_height: float = 540.0) -> tuple[DataFrame, DataFrame]:
    """The slides of a deck with a text layer: (deck, slide, pos, role, level, text) without the lines that repeat at the edges of its slides, and
    (deck, removed), up to five of these. lines_(deck, slide, pos, box, text, bullet_x). slide_parts.deck_structure joins the lines to what they make."""
    kept, shown = without_repeats(lines_, deck, slide, page_height)
    roles = structured(bullet_levels(kept, deck), deck, slide, page_height)
    return roles.select(*deck, slide, "pos", "role", "level", "text"), shown


def deck_index(slides_: DataFrame, deck: list[str]) -> DataFrame:
    """(deck, n_slides, n_images, n_flagged, n_hidden, index_md): what a deck's package says of it: counts, and a table with a row a slide.

    slides_(deck, slide_no, title, hidden, has_table, has_notes, image, rate, flags). A rate is shown in whole per cent; a slide without one, a
    title or flags has a dash there.
    """
    dash = lambda c: F.when(F.coalesce(c, F.lit("")) == "", "–").otherwise(c)
    told = F.array_join(F.coalesce("flags", F.array().cast("array<string>")), "; ")
    cells = F.array(F.col("slide_no").cast("string"), dash(table_cell(F.col("title"))), F.when(F.col("has_table"), "yes").otherwise(""), F.when(F.col("has_notes"), "yes").otherwise(""), dash(F.concat(F.round(F.col("rate") * 100).cast("int").cast("string"), F.lit(" %"))), dash(table_cell(told)))
    rows = slides_.select(*deck, "slide_no", "hidden", "image", (F.size("flags") > 0).alias("flagged"), F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |")).alias("line"))
    n = lambda c: F.count(F.when(F.col(c), 1))
    per = rows.groupBy(*deck).agg(F.count(F.lit(1)).alias("n_slides"), n("image").alias("n_images"), n("flagged").alias("n_flagged"), n("hidden").alias("n_hidden"), F.array_sort(F.collect_list(F.struct("slide_no", "line"))).alias("r"))  # of one deck
    head = F.lit("| # | Title | Table | Notes | Coverage | Flags |\n|---|---|---|---|---|---|\n")
    return per.select(*deck, "n_slides", "n_images", "n_flagged", "n_hidden", F.concat(head, F.array_join(F.transform("r", lambda x: x["line"]), "\n")).alias("index_md"))
