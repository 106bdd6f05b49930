"""What changed: hashes, manifests, folders, freshness.

Edge cases: a null content has a null hash, which is a content of its own; files of a null path are never done (they are processed each time);
a path listed twice is processed twice; equal extensions go to the smaller path; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Which presentation format is preferred.
PRIORITY = ["pptx", "ppsx", "ppt", "pps", "odp"]


def content_hashes(df: DataFrame, key: list[str], content: str) -> DataFrame:
    return df.select(*key, F.sha1(F.col(content).cast("binary")).alias("sha1"), F.md5(F.col(content).cast("binary")).alias("md5"))


def duplicate_files(hashes: DataFrame, key: str, digest: str = "sha1") -> DataFrame:
    """Contents that several files share: the smallest key and how many; summed before the shuffle."""
    return hashes.groupBy(digest).agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")


def changes(now: DataFrame, before: DataFrame, key: str = "path", digest: str = "sha1") -> DataFrame:
    """(key, change): added, removed, changed or unchanged, by a full join."""
    n, b = now.select(key, F.col(digest).alias("now")), before.select(key, F.col(digest).alias("before"))
    kind = F.when(F.col("before").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("now") != F.col("before"), "changed").otherwise("unchanged")
    return n.join(b, key, "full").select(key, kind.alias("change"))


def to_process(files: DataFrame, manifest: DataFrame, version: str, key: str = "path", digest: str = "sha1") -> DataFrame:
    """Files that the manifest does not hold with this version and content."""
    done = manifest.filter(F.col("version") == version).select(key, digest)
    return files.join(done, [key, digest], "left_anti")


def decks(files: DataFrame, path: str = "path") -> DataFrame:
    """(folder, stem, pres_path, pdf_path): presentations and PDFs of one name in one folder; hidden and lock files are left out."""
    p = F.col(path)
    rows = files.select(p.alias("path"), F.regexp_extract(p, r"^(.*)/[^/]*$", 1).alias("folder"), F.regexp_extract(p, r"([^/]*)$", 1).alias("name")).filter("NOT name LIKE '~$%' AND NOT name LIKE '.%'")
    rows = rows.withColumn("ext", F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1))).withColumn("stem", F.regexp_replace("name", r"\.[^.]+$", ""))
    place = F.array_position(F.array(*[F.lit(x) for x in PRIORITY]), F.col("ext"))
    pres = F.min_by(F.when(place > 0, F.col("path")), F.when(place > 0, place))
    found = rows.filter((place > 0) | (F.col("ext") == "pdf")).groupBy("folder", "stem").agg(pres.alias("pres_path"), F.min(F.when(F.col("ext") == "pdf", F.col("path"))).alias("pdf_path"))
    return found


def stale(outputs: DataFrame, inputs: DataFrame, key: list[str]) -> DataFrame:
    """Keys whose newest input is later than their output, or that have no output; both have modified (a time)."""
    newest = inputs.groupBy(*key).agg(F.max("modified").alias("newest"))
    made = outputs.groupBy(*key).agg(F.max("modified").alias("made"))
    return newest.join(made, key, "left").filter("made IS NULL OR newest > made").select(*key)


def latest(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The last row of each key in an order."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("rank = 1").drop("rank")


def reading_way(presentation: Column, pdf: Column, n_slides: Column, n_shown: Column, n_pages: Column, has_text: Column) -> Column:
    """How a deck is read: its text from the presentation if there is one, with pictures from a PDF whose pages are its slides (all, or those shown), else
    from a rendering; without one from the PDF's text layer, or by OCR where it has none. Null if there is neither file."""
    fits = F.coalesce(pdf.isNotNull() & ((n_pages == n_slides) | (n_pages == n_shown)), F.lit(False))
    return F.when(presentation.isNotNull(), F.when(fits, "presentation and pdf").otherwise("presentation and rendering")).when(pdf.isNotNull(), F.when(F.coalesce(has_text, F.lit(False)), "pdf").otherwise("pdf of images"))
