"""Derived columns of blocks and the text-layer test of pages."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions import text as tx

MIN_LAYER_CHARS, IMAGE_PAGE_CHARS, IMAGE_PAGE_SHARE = 10, 60, 0.5


def share(value: str, of: str) -> Column:
    """value / of, 0 where the page has no such dimension."""
    return F.when(F.col(of) != 0, F.col(value) / F.col(of)).otherwise(0.0)


def with_geometry(blocks: DataFrame) -> DataFrame:
    """blocks with width, height, font, x0f, y0f, x1f, y1f and n_words."""
    return blocks.select(
        "*",
        (F.col("x1") - F.col("x0")).alias("width"),
        (F.col("y1") - F.col("y0")).alias("height"),
        tx.mean_font(F.col("font_sizes")).alias("font"),
        share("x0", "page_width").alias("x0f"),
        share("y0", "page_height").alias("y0f"),
        share("x1", "page_width").alias("x1f"),
        share("y1", "page_height").alias("y1f"),
        tx.word_count(F.col("text")).alias("n_words"),
    )


def image_share(pages: DataFrame, images: DataFrame) -> DataFrame:
    """pages with image_area_frac: image boxes (doc_id, page_index, w, h) over the page, overlaps counted twice."""
    area = images.groupBy("doc_id", "page_index").agg(F.sum(F.col("w") * F.col("h")).alias("__a"))
    page = F.col("width") * F.col("height")
    return pages.drop("image_area_frac").join(area, ["doc_id", "page_index"], "left").withColumn("image_area_frac", F.when(page > 0, F.coalesce("__a", F.lit(0.0)) / page).otherwise(0.0)).drop("__a")


def text_layer(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """pages with has_text_layer: enough characters, and not a scan with a stray caption."""
    chars = blocks.groupBy("doc_id", "page_index").agg(F.sum(F.length("text")).alias("__n"))
    n = F.coalesce("__n", F.lit(0))
    scanned = (n <= IMAGE_PAGE_CHARS) & (F.coalesce("image_area_frac", F.lit(0.0)) >= IMAGE_PAGE_SHARE)
    return pages.drop("has_text_layer").join(chars, ["doc_id", "page_index"], "left").withColumn("has_text_layer", (n >= MIN_LAYER_CHARS) & ~scanned).drop("__n")


def ocr_text(images: DataFrame, read: Callable[[bytes], str] | None) -> DataFrame:
    """(doc_id, page_index, text, error) of page images (doc_id, page_index, image).

    ``read`` is any OCR engine: image bytes to text.  None stands for "no engine
    here": no page is read, and all of them end up in the review reasons.  A
    page that the engine fails on has the error and no text; the others go on.
    """
    schema = f"doc_id {dict(images.dtypes)['doc_id']}, page_index int, text string, error string"
    if read is None:
        return images.sparkSession.createDataFrame([], schema)

    def run(batches):
        for t in batches:
            rows = []
            for doc, page, image in zip(t["doc_id"], t["page_index"], t["image"]):
                try:
                    rows.append((doc, page, (read(bytes(image)) or "").strip(), None))
                except Exception as e:  # whatever an engine raises concerns this page only
                    rows.append((doc, page, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["doc_id", "page_index", "text", "error"])

    return images.select("doc_id", "page_index", "image").mapInPandas(run, schema)


def inject_ocr(blocks: DataFrame, pages: DataFrame, ocr: DataFrame) -> DataFrame:
    """blocks in which pages without a text layer that OCR could read hold one
    full-page block; such pages keep has_text_layer = false."""
    read = ocr.where(F.length(F.coalesce("text", F.lit(""))) > 0).join(pages.where("NOT has_text_layer"), ["doc_id", "page_index"])
    full = read.select(
        "doc_id", "page_index", F.lit(0).alias("block_index"), F.col("width").alias("page_width"), F.col("height").alias("page_height"),
        F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.col("width").alias("x1"), F.col("height").alias("y1"), "text", F.array().cast("array<double>").alias("font_sizes"),
    )
    return blocks.join(read.select("doc_id", "page_index"), ["doc_id", "page_index"], "left_anti").select(*full.columns).unionByName(full)
