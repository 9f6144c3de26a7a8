"""Landed web pages to typed state: one embedded script per page, allow-listed fields."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCRIPT = r"(?is)<script[^>]*>(.*?)</script>"


def page_state(pages: DataFrame, key: str, html: str, fields: Mapping[str, str]) -> DataFrame:
    """The text of the single script of a page and the fields its patterns find; other scripts are a problem.

    Nothing but the named fields is taken over from the page.
    """
    found = F.regexp_extract_all(F.col(html), F.lit(SCRIPT), F.lit(1))
    scripts = pages.select(key, html, found.alias("_s")).withColumn("scripts", F.size("_s"))
    state = F.when(F.col("scripts") == 1, F.get("_s", F.lit(0)))
    picked = [F.nullif(F.regexp_extract(state, p, 1), F.lit("")).alias(n) for n, p in fields.items()]
    problem = F.when(F.col("scripts") == 0, "no-state").when(F.col("scripts") > 1, "several-states")
    return scripts.select(key, "scripts", *picked, problem.alias("problem"))


def page_title(html: Column) -> Column:
    """Text of the title element."""
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def visible_text(html: Column) -> Column:
    """Page text without scripts, styles, comments and tags, white space collapsed."""
    text = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(?:script|style)>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def list_items(pages: DataFrame, key: str, html: str, pattern: str, page_size: int) -> DataFrame:
    """Items of list pages: (page, slot, item), with a flag for pages that list more than they may."""
    items = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))
    listed = pages.select(key, items.alias("_items"))
    rows = listed.select(key, F.posexplode_outer("_items").alias("slot", "item"), (F.size("_items") > page_size).alias("over_full"))
    return rows.where("item is not null")
