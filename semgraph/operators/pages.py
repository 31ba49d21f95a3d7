"""Results in pages: written once, then any stretch of rows is read from the files that hold it (SRC-15)."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

MANIFEST = "file string, first long, n long"


def _order(path: str) -> tuple[int, int, str]:
    """Part and place among the files of its task, which Spark's writer puts in a file's name."""
    name = path.rsplit("/", 1)[-1]
    part, piece = re.search(r"part-(\d+)", name), re.search(r"[.-]c(\d+)", name)
    return int(part[1]) if part else 0, int(piece[1]) if piece else 0, name


class Pages:
    """A result in ``folder``: its rows keep the order in which the frame gave them, and each has a place from 0 on.

    The manifest has a row a file, the first place in it and its rows; the
    driver holds that, never the rows.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").collect()
        self.files = sorted(((r["first"], r["n"], r["file"]) for r in rows), key=lambda r: r[0])
        self.schema = StructType.fromJson(spark.read.parquet(f"{folder}/schema").schema.jsonValue())
        self.rows = sum(n for _, n, _ in self.files)

    @classmethod
    def write(cls, df: DataFrame, folder: str, rows_a_file: int = 100_000) -> Pages:
        """Runs ``df`` once, into files of at most ``rows_a_file`` rows.

        A frame with an order (ORDER BY) gives pages in that order, as its
        partitions and the files of each follow it; one without gives each row
        in one page, in an order that stays.  A column that can't be Parquet is
        Spark's own error; ``place`` is taken by the pages.
        """
        if "place" in {c.lower() for c in df.columns}:
            raise ValueError("a column may not be named place")
        spark = df.sparkSession
        df.write.option("maxRecordsPerFile", rows_a_file).parquet(f"{folder}/rows")
        spark.createDataFrame([], df.schema).write.parquet(f"{folder}/schema")
        written = spark.read.schema(df.schema).parquet(f"{folder}/rows")
        counted = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n")).collect()
        manifest, first = [], 0
        for r in sorted(counted, key=lambda r: _order(r["file"])):
            manifest.append((r["file"], first, r["n"]))
            first += r["n"]
        spark.createDataFrame(manifest, MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest")
        return cls(spark, folder)

    def touched(self, start: int, rows: int) -> list[tuple[int, int, str]]:
        """(first, n, file) of the files that hold places from ``start`` on, ``rows`` of them."""
        low = max(0, bisect_right([f[0] for f in self.files], start) - 1)
        return [f for f in self.files[low:] if f[0] < start + rows and f[0] + f[1] > start]

    def read(self, start: int, rows: int) -> DataFrame:
        """The rows at places ``start`` to ``start + rows``, with their place; fewer at the end, none beyond it."""
        if start < 0 or rows < 0:
            raise ValueError("start and rows are at least 0")
        files = self.touched(start, rows)
        if not files:
            return self.spark.createDataFrame([], StructType([*self.schema.fields, StructField("place", LongType())]))
        found = self.spark.read.schema(self.schema).parquet(*(f for _, _, f in files))
        # A page touches few files, so their first places fit in the plan.
        firsts = F.create_map(*(x for first, _, file in files for x in (F.lit(file), F.lit(first))))
        place = F.element_at(firsts, F.col("_metadata.file_path")) + F.col("_metadata.row_index")
        return found.withColumn("place", place).where(F.col("place").between(start, start + rows - 1))

    def pages(self, size: int) -> Iterator[DataFrame]:
        """All pages of ``size`` rows, in order, each a frame of its own."""
        if size < 1:
            raise ValueError("size is at least 1")
        for start in range(0, self.rows, size):
            yield self.read(start, size)
