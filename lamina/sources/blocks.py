"""Sources of positioned text blocks.

``pdfblocks`` is a Python data source, one partition per file, that needs a PDF
library on the workers; where there is none it says so.  The two pseudo
layouts make blocks from plain tables with integer arithmetic, for checks.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lamina.operators.layout import text_layer
from lamina.schema import BLOCKS


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        import glob
        import os

        root = self.options.get("path", "")
        found = [root] if os.path.isfile(root) else sorted(glob.glob(os.path.join(root, "**", "*.pdf"), recursive=True))
        return [_File(p) for p in found]

    def read(self, partition):
        try:
            import fitz
        except ImportError as e:
            raise RuntimeError("pdfblocks needs PyMuPDF on the workers; read prepared block tables otherwise") from e
        wanted = {int(p) for p in self.options.get("pages", "").split(",") if p.strip()}
        with fitz.open(partition.path) as doc:
            for page in doc:
                if wanted and page.number + 1 not in wanted:
                    continue
                at = 0
                for block in page.get_text("dict")["blocks"]:
                    if block.get("type") != 0:
                        continue
                    rows = ["".join(s["text"] for s in line["spans"]) for line in block["lines"]]
                    text = "\n".join(r for r in rows if r.strip()).strip()
                    if not text:
                        continue
                    box = fitz.Rect(block["bbox"]) * page.rotation_matrix
                    box.normalize()
                    sizes = [float(s["size"]) for line in block["lines"] for s in line["spans"] if s["size"]]
                    yield partition.path, page.number, at, float(page.rect.width), float(page.rect.height), box.x0, box.y0, box.x1, box.y1, text, sizes
                    at += 1


class PdfBlocks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pdfblocks"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema):
        return _Reader(self.options)


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of every PDF under a folder, by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(folder)
    return files.select("path", "length").orderBy("path")


def pdf_blocks(spark: SparkSession, folder: str, pages: str = "") -> DataFrame:
    spark.dataSource.register(PdfBlocks)
    return spark.read.format("pdfblocks").option("pages", pages).load(folder)


PAGE_ROWS = (
    "doc_id string, page_index int, width double, height double, image_area_frac double, error string, "
    "blocks array<struct<block_index:int,x0:double,y0:double,x1:double,y1:double,text:string,font_sizes:array<double>>>"
)


def parse_pdf(content: bytes) -> list[dict]:
    """The pages of a PDF: width, height, image_area_frac and blocks."""
    import fitz

    pages = []
    with fitz.open(stream=content, filetype="pdf") as doc:
        for page in doc:
            blocks, images = [], 0.0
            for block in page.get_text("dict")["blocks"]:
                box = fitz.Rect(block["bbox"]) * page.rotation_matrix
                box.normalize()
                if block.get("type") != 0:
                    images += box.width * box.height
                    continue
                rows = ["".join(s["text"] for s in line["spans"]) for line in block["lines"]]
                text = "\n".join(r for r in rows if r.strip()).strip()
                if text:
                    sizes = [float(s["size"]) for line in block["lines"] for s in line["spans"] if s["size"]]
                    blocks.append((len(blocks), box.x0, box.y0, box.x1, box.y1, text, sizes))
            area = page.rect.width * page.rect.height
            pages.append({"width": float(page.rect.width), "height": float(page.rect.height), "image_area_frac": images / area if area else 0.0, "blocks": blocks})
    return pages


def pdf_pages(spark: SparkSession, folder: str, parse: Callable[[bytes], list[dict]] = parse_pdf) -> DataFrame:
    """A row for each page of each PDF under a folder of any file system that
    Spark reads, pages without blocks included; a file that can't be parsed is
    one row with its error, and the others go on."""
    names = ["doc_id", "page_index", "width", "height", "image_area_frac", "error", "blocks"]

    def run(batches):
        for t in batches:
            for path, content in zip(t["path"], t["content"]):
                try:
                    rows = [(path, i, p["width"], p["height"], p["image_area_frac"], None, [tuple(b) for b in p["blocks"]]) for i, p in enumerate(parse(bytes(content)))]
                except Exception as e:  # whatever a parser raises concerns this file only
                    rows = [(path, None, None, None, None, f"{type(e).__name__}: {e}", [])]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names) if rows else pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names=names)

    block = pa.struct([("block_index", pa.int32()), *((c, pa.float64()) for c in ("x0", "y0", "x1", "y1")), ("text", pa.string()), ("font_sizes", pa.list_(pa.float64()))])
    kinds = [pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.string(), pa.list_(block)]

    def as_arrow(batches):
        yield from run({"path": b.column(0).to_pylist(), "content": b.column(1).to_pylist()} for b in batches)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(folder)
    return files.select("path", "content").mapInArrow(as_arrow, PAGE_ROWS)


def tables_of(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, pages, blocks) of ``pdf_pages``, as the extraction takes
    them: documents with filename and error, pages with their text-layer test."""
    good = pages.where("error IS NULL")
    documents = pages.groupBy("doc_id").agg(F.max("error").alias("error")).select("doc_id", F.element_at(F.split("doc_id", "/"), -1).alias("filename"), "error")
    blocks = good.select("doc_id", "page_index", F.col("width").alias("page_width"), F.col("height").alias("page_height"), F.inline("blocks"))
    blocks = blocks.select("doc_id", "page_index", "block_index", "page_width", "page_height", "x0", "y0", "x1", "y1", "text", "font_sizes")
    return documents, text_layer(good.select("doc_id", "page_index", "width", "height", "image_area_frac"), blocks), blocks


def line_blocks(docs: DataFrame, lines_per_page: int = 12) -> DataFrame:
    """Each line of a document as a block of a 600 x 800 page (synthetic).

    Documents are partitioned by doc_id before they are cut, so what follows by
    document or page needs no further shuffle of blocks."""
    n = lines_per_page
    rows = docs.select("doc_id", "text").repartition("doc_id").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("k", "text"))
    r, size = F.col("k") % n, F.length("text")
    x0 = F.when(size % 5 == 0, 380).otherwise(60)
    y0 = 40 + 60 * r
    return rows.select(
        "doc_id", F.floor(F.col("k") / n).cast("int").alias("page_index"), r.cast("int").alias("block_index"), F.lit(600.0).alias("page_width"), F.lit(800.0).alias("page_height"),
        x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), F.least(x0 + F.least(size * 5, F.lit(480)), F.lit(600)).cast("double").alias("x1"), (y0 + 12 + 12 * (size % 3)).cast("double").alias("y1"),
        "text", F.array((10 + size % 3).cast("double")).alias("font_sizes"),
    )


def link_blocks(pages: DataFrame) -> DataFrame:
    """Each list link of a web page as a small block, six to a row, neighbours
    a little out of line (synthetic)."""
    rows = pages.select(F.col("page_id").alias("doc_id"), F.posexplode(F.regexp_extract_all("html", F.lit("<li><a[^>]*>([^<]*)</a>"), F.lit(1))).alias("k", "text"))
    x0, y0 = 10 + 98 * (F.col("k") % 6), 40 + 40 * F.floor(F.col("k") / 6) + 4 * (F.col("k") % 2)
    return rows.select(
        "doc_id", F.lit(0).alias("page_index"), F.col("k").cast("int").alias("block_index"), F.lit(600.0).alias("page_width"), F.lit(800.0).alias("page_height"),
        x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), (x0 + 60).cast("double").alias("x1"), (y0 + 12).cast("double").alias("y1"), "text", F.array((10 + F.length("text") % 2).cast("double")).alias("font_sizes"),
    )


def pages_of(blocks: DataFrame) -> DataFrame:
    """Every page of a block table, as one with a text layer."""
    return blocks.groupBy("doc_id", "page_index").agg(F.first("page_width").alias("width"), F.first("page_height").alias("height")).select("*", F.lit(True).alias("has_text_layer"), F.lit(0.0).alias("image_area_frac"))
