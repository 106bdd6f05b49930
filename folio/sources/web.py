"""Blocks of web pages by SQL functions: headings, items and paragraphs in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.text import squeeze

_BLOCK = r"(?is)(<(?:h[1-6]|li|p|td|th)\b[^>]*>.*?(?=</(?:h[1-6]|li|p|td|th)>|<(?:h[1-6]|li|p|td|th)\b|\z))"


def blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, kind, text): a block's text without tags and with the five basic entities read; empty blocks are left out."""
    bare = F.regexp_replace(F.col(html), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", "")
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(bare, F.lit(_BLOCK), F.lit(1))).alias("pos", "b"))
    tag = F.lower(F.regexp_extract("b", r"^<([A-Za-z0-9]+)", 1))
    kind = F.when(tag.rlike("^h[1-6]$"), "heading").when(tag == "li", "item").when(tag == "p", "paragraph").otherwise("cell")
    text = squeeze(F.regexp_replace("b", r"(?s)<[^>]*>", ""))
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(sign))
    return rows.select(key, "pos", kind.alias("kind"), text.alias("text")).filter("text <> ''")
