"""Text corpora: folders of .txt files and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.session import cut

SIDECAR = ".excluded.txt"


def text_files(spark: SparkSession, folder: str, recursive: bool = False, sidecars: bool = True) -> DataFrame:
    """(name, group, text) of every .txt file.  ``group`` is the first folder
    below ``folder``; ``sidecars``: include files of excluded text, as the
    plain glob would."""
    read = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    path = F.col("_metadata.file_path")
    inner = F.regexp_replace(path, "^.*?" + _quoted(folder.rstrip("/")) + "/", "")
    out = read.select(F.col("_metadata.file_name").alias("name"), F.get(F.split(inner, "/"), F.lit(0)).alias("group"), F.col("value").alias("text"))
    return out if sidecars else out.where(~F.col("name").endswith(SIDECAR))


def _quoted(path: str) -> str:
    return "\\Q" + path.removeprefix("file:") + "\\E"


def numbered(corpus: DataFrame, by: str = "name") -> DataFrame:
    """corpus with doc_idx: places from 0 by name, through a distributed sort."""
    # written once: a second sort, of other columns, may draw the bounds of its parts elsewhere
    parts = cut(corpus.orderBy(by).withColumn("__at", F.monotonically_increasing_id()))
    part, row = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = parts.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per part of the sort
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.withColumn("__p", part).join(sizes.select("__p", before.alias("__b")), "__p").withColumn("doc_idx", F.col("__b") + row).drop("__at", "__p", "__b")


def drop_last(table: DataFrame, order: str) -> DataFrame:
    """Without the row that comes last, such as a sheet's totals."""
    last = table.agg(F.max(order).alias("__l"))
    return table.join(F.broadcast(last), table[order] == last["__l"], "left_anti")  # one row


def descriptions(spark: SparkSession, path: str) -> DataFrame:
    """Spreadsheet rows exported as CSV: name and description, last row dropped."""
    sheet = spark.read.csv(path, header=True, multiLine=True).withColumn("__k", F.monotonically_increasing_id())
    return drop_last(sheet, "__k").select(F.col("EMPLOYEE NAME").alias("name"), F.col("Description of case").alias("text"))
