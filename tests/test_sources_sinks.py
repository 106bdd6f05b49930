"""Readers, writers and incremental runs on files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from folio.functions.text import chapter_file
from folio.operators import pack, textclean
from folio.plans import sinks
from folio.plans.scan_queries import small_deck
from folio.plans.flow_queries import png_head
from folio.sources import deck_writer, package, pictures
from folio.sources.decks import PptxSource
from folio.streaming import chapters, ingest


def test_pptx_source(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.pptx").write_bytes(small_deck())
    (tmp_path / "~$a.pptx").write_bytes(b"lock file")
    spark.dataSource.register(PptxSource)
    rows = spark.read.format("pptx").load(str(tmp_path)).orderBy("slide_no", "pos").collect()
    assert [(r.slide_no, r.kind, r.text) for r in rows] == [(1, "title", "Plan"), (1, "text", "First"), (1, "text", "Second"), (2, "text", "Hidden text"), (2, "footer", "Foot")]
    assert {r.path for r in rows} == {str(tmp_path / "sub" / "a.pptx")}


def test_only_new_files_are_read(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    docs.filter("doc_id < 50").coalesce(1).write.parquet(source)
    ingest.run_once(spark, source, out, state, ingest.registered)
    assert spark.read.parquet(out).count() == 50
    docs.filter("doc_id BETWEEN 50 AND 59").coalesce(1).write.mode("append").parquet(source)
    ingest.run_once(spark, source, out, state, ingest.registered)
    ingest.run_once(spark, source, out, state, ingest.registered)
    rows = spark.read.parquet(out)
    assert rows.count() == rows.distinct().count() == 60


def test_sinks(spark, tmp_path):
    chapters = spark.createDataFrame([("01_A.md", "# A\n\ntext"), ("02_B.md", "b")], "file_name string, md string")
    sinks.write_markdown(chapters, str(tmp_path / "md"))
    back = {r.file_name: r.value for r in spark.read.text(str(tmp_path / "md"), wholetext=True).collect()}
    assert {k: v.strip() for k, v in back.items()} == {"01_A.md": "# A\n\ntext", "02_B.md": "b"}
    sinks.write_reports(spark.createDataFrame([("d", 1, "x")], "deck string, slide int, flag string"), str(tmp_path / "json"), ["deck"])
    assert spark.read.json(str(tmp_path / "json")).first().flag == "x"
    sinks.record(spark.createDataFrame([("p", "s")], "path string, sha1 string"), str(tmp_path / "manifest"), "3")
    assert tuple(spark.read.parquet(str(tmp_path / "manifest")).first()) == ("p", "3", "s")


def test_chapter_files_and_outline(spark):
    rows = spark.createDataFrame([("chapter", "3", "On: sets"), ("appendix", "A", "More"), ("chapter", "12", "")], "kind string, no string, title string")
    names = [r[0] for r in rows.select(chapter_file(F.col("kind"), F.col("no"), F.col("title"))).collect()]
    assert names == ["03_On_sets.md", "App_A_More.md", "12_Chapter_12.md"]
    md = spark.createDataFrame([(1, "# Top\n## **One**\ntext\n### Key points\n#### Two #\n##### deep")], "no int, md string")
    assert [r.title for r in pack.markdown_outline(md, ["no"]).orderBy("pos").collect()] == ["One", "Two"]


def test_tidy(spark):
    text = "# **2**\nA ~~2.1~~ part.\n- Figure 1.1 Cap\n  3. item\n\n\n\nend"
    assert spark.range(1).select(textclean.tidy(F.lit(text))).first()[0] == "A 2.1 part.\nFigure 1.1 Cap\n3. item\n\nend"


# ---- packages ----------------------------------------------------------------------------------


def files_of(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


def test_package_is_the_old_one_or_the_new_one(spark, tmp_path):
    rows = lambda n, *more: spark.createDataFrame([(f"a/{i}.md", f"text {i} é", "x") for i in range(n)] + list(more), "path string, content string, other string").repartition(4)
    root = str(tmp_path / "p")
    read = lambda: {r.path: bytes(r.content).decode() for r in package.read_package(spark, root).collect()}
    assert read() == {} and package.current(root) is None and package.sweep(root) == 0
    package.write_package(rows(20), root)
    first = {f"a/{i}.md": f"text {i} é" for i in range(20)}
    assert read() == first and package.current(root).endswith("/v-1")
    before = {p: (tmp_path / "p" / p).stat().st_mtime_ns for p in files_of(tmp_path / "p")}
    package.write_package(rows(20).repartition(2), root)  # the same again writes nothing
    assert before == {p: (tmp_path / "p" / p).stat().st_mtime_ns for p in files_of(tmp_path / "p")}
    # a task that fails half way: the run is aborted and the old package whole
    for bad in ("../out.md", "/abs", "a//b", None):
        with pytest.raises(Exception, match="no place within a package"):
            package.write_package(rows(30, (bad, "x", "")), root)
        assert read() == first
    package.sweep(root)
    with pytest.raises(ValueError, match="one path"):
        package.write_package(rows(20, ("a/1.md", "again", "")), root)
    # a file that someone put there stays, one that is not made any more goes
    (tmp_path / "p" / "v-1" / "answers").mkdir()
    (tmp_path / "p" / "v-1" / "answers" / "mine.txt").write_text("my own")
    (tmp_path / "p" / "v-1" / "junk.txt").write_text("junk")
    package.write_package(rows(3, ("b.md", None, "")), root, protected="^answers/")
    assert read() == {**{k: v for k, v in first.items() if int(k[2:-3]) < 3}, "answers/mine.txt": "my own"}
    assert (tmp_path / "p" / "v-2" / "b.md").read_text() == ""
    assert files_of(tmp_path / "p" / "v-1") and not list((tmp_path / "p").glob(".staging*"))
    package.write_package(rows(4), root)
    assert not (tmp_path / "p" / "v-1").exists() and package.current(root).endswith("/v-3")


def test_a_killed_run_leaves_the_old_package(spark, tmp_path):
    root = str(tmp_path / "p")
    package.write_package(spark.createDataFrame([("a", "1")], "path string, content string"), root)
    (tmp_path / "p" / ".staging-killed" / "a").mkdir(parents=True)  # killed while tasks wrote
    (tmp_path / "p" / "v-2").mkdir()  # killed between the two renames
    (tmp_path / "p" / "v-2" / "half").write_text("x")
    assert [tuple(r) for r in package.read_package(spark, root).collect()] == [("a", bytearray(b"1"))]
    package.write_package(spark.createDataFrame([("a", "2")], "path string, content string"), root)
    assert [tuple(r) for r in package.read_package(spark, root).collect()] == [("a", bytearray(b"2"))] and package.sweep(root) == 1
    package.write_package(spark.createDataFrame([], "path string, content string"), root)
    assert package.read_package(spark, root).count() == 0


# ---- chapters of a stream ----------------------------------------------------------------------


def test_chapters_come_when_they_are_complete(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "chapter string, page int, wanted int, text string"

    def more(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        pages = spark.readStream.schema(schema).parquet(source)
        chapters.run(chapters.complete_chapters(pages, "chapter", "page", "wanted", "text"), out, state)
        return sorted(tuple(r) for r in spark.read.schema(chapters.OUT).parquet(out).collect())

    assert more(("a", 2, 3, "two"), ("b", 1, 1, None), ("a", 2, 3, "two again"), (None, 1, 1, "x"), ("c", None, 1, "x")) == [("b", "complete", 1, "")]
    assert more(("a", 3, 3, "three")) == [("b", "complete", 1, "")]  # each run goes on from the checkpoint of the one before
    done = [("a", "complete", 3, "one\n\ntwo\n\nthree"), ("b", "complete", 1, "")]
    assert more(("a", 1, 3, "one"), ("d", 1, 2, "x")) == done
    assert more(("a", 2, 3, "late")) == [done[0], ("a", "late", 1, "late"), done[1]]
    assert spark.conf.get(chapters.PROVIDER, None) != chapters.ROCKS


def test_same_chapters_whatever_the_files(spark, tmp_path):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").dropDuplicates(["conv_id", "turn"])
    pages = turns.join(turns.groupBy("conv_id").count().withColumnRenamed("count", "wanted"), "conv_id").select(F.col("conv_id").cast("string").alias("chapter"), F.col("turn").cast("int").alias("page"), F.col("wanted").cast("int").alias("wanted"), "text")
    pages.repartition(5, "page").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    chapters.run(chapters.complete_chapters(stream, "chapter", "page", "wanted", "text"), str(tmp_path / "out"), str(tmp_path / "state"))
    whole = {r.chapter: "\n\n".join(t.text or "" for t in sorted(r.t)) for r in pages.groupBy("chapter").agg(F.collect_list(F.struct("page", "text")).alias("t")).collect()}
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.chapter: r.text for r in got} == whole and len(got) == len(whole) and {r.state for r in got} == {"complete"}


# ---- pictures ----------------------------------------------------------------------------------


def test_pictures_of_decks(spark):
    png = png_head(1, 60, 50)
    jpeg = b"\xff\xd8\xff\xe0" + (16).to_bytes(2, "big") + b"\0" * 14 + b"\xff\xc2" + (17).to_bytes(2, "big") + b"\x08" + (300).to_bytes(2, "big") + (400).to_bytes(2, "big") + b"\0" * 10
    assert [pictures.size_of(d) for d in (png, jpeg, b"GIF89a" + bytes([64, 0, 50, 0]), b"", b"\xff\xd8\xff", b"none")] == [(60, 50), (400, 300), (64, 50), None, None, None]
    shapes = lambda *ids: [deck_writer.picture(i, 10) for i in ids]
    links = {"a": "ppt/media/a.png", "b": "ppt/media/b.png", "c": "ppt/media/c.jpg", "gone": "ppt/media/gone.png"}
    parts = {"ppt/media/a.png": png, "ppt/media/b.png": png, "ppt/media/c.jpg": jpeg}
    deck = deck_writer.deck([{"shapes": shapes("c", "a", "gone"), "links": links, "parts": parts}, {"shapes": shapes("b"), "links": links}, {"shapes": shapes("s", "x"), "links": {"s": "ppt/media/s.png", "x": "ppt/media/x.emf"}, "parts": {"ppt/media/s.png": png_head(2, 47, 90), "ppt/media/x.emf": b"vector"}}])
    files = spark.createDataFrame([("d", deck), ("bad", b"no zip"), ("null", None)], "path string, content binary").withColumn("sha1", F.lit("own"))
    media = pictures.embedded(files)
    assert [(r.slide_no, r.place, r.part.rsplit("/", 1)[1], r.width) for r in media.orderBy("slide_no", "place").collect()] == [(1, 0, "c.jpg", 400), (1, 1, "a.png", 60), (2, 0, "b.png", 60), (3, 0, "s.png", 47), (3, 1, "x.emf", None)]
    assert sorted((r.slide_no, r.place, r.width, r.n) for r in pictures.once(media).collect()) == [(1, 0, 400, 1), (1, 1, 60, 2)]
    assert pictures.embedded(files.limit(0)).count() == 0
