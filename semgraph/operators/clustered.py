"""Tables of files clustered by key, of which a write makes anew only the files it touches (SNK-01, SNK-10).

A manifest lists each file of a version with its range of keys, rows and bytes.
A write copies the touched files' other rows and its own into new files, writes
a manifest beside the old one, and then names it the next version by one rename
that fails if another writer was first.  Nothing that is read is overwritten.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(Exception):
    """Another writer made the next version first."""


@dataclass(frozen=True)
class File:
    path: str
    bytes: int
    rows: int
    low: object
    high: object


@dataclass(frozen=True)
class Report:
    """What a write made: the version, its files and bytes, and how many of them are new."""

    version: int
    files: int
    bytes: int
    new_files: int
    new_bytes: int


@dataclass(frozen=True)
class Clustered:
    """A table in ``folder`` by ``keys``; files are ranges of the first key, of about ``rows`` rows.  A manifest has a row a file and is read by the driver."""

    spark: SparkSession
    folder: str
    keys: tuple[str, ...]
    rows: int = 1_000_000

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The newest version; 0 before the first write."""
        fs, path = self._fs(), self._path(f"{self.folder}/versions")
        return max((int(s.getPath().getName()) for s in fs.listStatus(path) if s.getPath().getName().isdigit()), default=0) if fs.exists(path) else 0

    def _manifest(self, version: int) -> tuple[T.StructType, list[File]]:
        stream = self._fs().open(self._path(f"{self.folder}/versions/{version:020d}"))
        try:
            said = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        files = self.spark.read.parquet(f"{self.folder}/manifests/{said['manifest']}").collect()
        return T.StructType.fromJson(said["schema"]), sorted((File(*(r[c] for c in ("path", "bytes", "rows", "low", "high"))) for r in files), key=lambda f: (f.low is not None, f.low))

    def _commit(self, version: int, schema: T.StructType, files: list[File]) -> None:
        """Names the files version ``version``; the rename is the one step that others see."""
        name = uuid.uuid4().hex
        kind = T._parse_datatype_string(f"path string, bytes long, rows long, low {schema[self.keys[0]].dataType.simpleString()}, high {schema[self.keys[0]].dataType.simpleString()}")
        self.spark.createDataFrame([(f.path, f.bytes, f.rows, f.low, f.high) for f in files], kind).coalesce(1).write.parquet(f"{self.folder}/manifests/{name}")
        fs, waiting, final = self._fs(), self._path(f"{self.folder}/versions/.{name}"), self._path(f"{self.folder}/versions/{version:020d}")
        fs.mkdirs(final.getParent())
        stream = fs.create(waiting, False)
        stream.write(bytearray(json.dumps({"manifest": name, "schema": json.loads(schema.json())}).encode()))
        stream.close()
        jvm = self.spark._jvm
        none = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = none
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(waiting.toUri(), self.spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(waiting), fs.makeQualified(final), options)
        except Py4JJavaError as e:
            fs.delete(waiting, False)
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                raise Conflict(f"version {version} of {self.folder} is there") from None
            raise

    def _frame(self, schema: T.StructType, files: list[File]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f.path for f in files)) if files else self.spark.createDataFrame([], schema)

    def _written(self, df: DataFrame, groups: int) -> list[File]:
        """Writes rows with their place ``_file`` among the old files, which no new file goes beyond."""
        folder = f"{self.folder}/data/{uuid.uuid4().hex}"
        key = self.keys[0]
        df.repartitionByRange(max(1, groups), "_file", key).sortWithinPartitions("_file", *self.keys).write.partitionBy("_file").parquet(folder)
        if self._fs().globStatus(self._path(f"{folder}/*/*.parquet")) in (None, []) or not len(self._fs().globStatus(self._path(f"{folder}/*/*.parquet"))):
            return []
        own = self.spark.read.schema(T.StructType([f for f in df.schema.fields if f.name != "_file"])).parquet(f"{folder}/*")
        found = own.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))
        return [File(unquote(r["path"]), r["bytes"], r["rows"], r["low"], r["high"]) for r in found.collect()]

    def _report(self, version: int, files: list[File], new: list[File]) -> Report:
        return Report(version, len(files), sum(f.bytes for f in files), len(new), sum(f.bytes for f in new))

    def read(self, low=None, high=None, version: int | None = None) -> DataFrame | None:
        """The table; given bounds of the first key, only the files that may hold keys between them are read.  None before the first write."""
        version = version or self.version()
        if not version:
            return None
        schema, files = self._manifest(version)
        inside = [f for f in files if f.low is None or ((high is None or f.low <= high) and (low is None or f.high >= low))]
        df, key = self._frame(schema, inside), F.col(self.keys[0])
        return df.where((key >= F.lit(low) if low is not None else F.lit(True)) & (key <= F.lit(high) if high is not None else F.lit(True)))

    def write(self, df: DataFrame) -> Report:
        """A version of these rows alone."""
        version, groups = self.version() + 1, -(-df.count() // self.rows)
        files = self._written(df.withColumn("_file", F.lit(0)), groups)
        self._commit(version, df.schema, files)
        return self._report(version, files, files)

    def _placed(self, df: DataFrame, files: list[File]) -> DataFrame:
        """``df`` with ``_file``: the last file that begins at or below the row's key, else the first."""
        lows = [f.low for f in files]
        borders = np.array([x for x in lows if x is not None], dtype=object if files and isinstance(next((x for x in lows if x is not None), None), str) else None)
        skip, names = len(lows) - len(borders), df.columns
        at = names.index(self.keys[0])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column(at).to_pylist()
                known = [i for i, v in enumerate(values) if v is not None]
                place = np.zeros(len(values), dtype=np.int32)
                if known and len(borders):
                    asked = np.array([values[i] for i in known], dtype=borders.dtype if borders.dtype == object else None)
                    place[known] = np.maximum(np.searchsorted(borders, asked, side="right") - 1, 0) + skip
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*names, "_file"])

        return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("_file", T.IntegerType())]))

    def upsert(self, new: DataFrame) -> Report:
        """SNK-01: rows of new keys are added, those of known keys replaced; new is one a key (else any of a key's), a null key replaces nothing.

        New columns are null in old rows, and missing ones in new rows.  Only
        files whose range holds one of the new keys are read and written.
        """
        version = self.version()
        new = new.dropDuplicates(list(self.keys))
        if not version:
            return self.write(new)
        schema, files = self._manifest(version)
        if not files:
            return self.write(self._frame(schema, []).unionByName(new, allowMissingColumns=True))
        placed = self._placed(new, files)
        # At most a row a file.
        touched = {r["_file"] for r in placed.select("_file").distinct().collect()}
        old = self._placed(self._frame(schema, [files[i] for i in sorted(touched)]), files)
        merged = old.join(new.select(*self.keys), list(self.keys), "left_anti").unionByName(placed, allowMissingColumns=True)
        groups = max(len(touched), -(-sum(files[i].rows for i in touched) // self.rows))
        made = self._written(merged, groups)
        after = [f for i, f in enumerate(files) if i not in touched] + made
        self._commit(version + 1, T.StructType([f for f in merged.schema.fields if f.name != "_file"]), after)
        return self._report(version + 1, after, made)

    def delete(self, where: Column) -> Report:
        """SNK-10: rows for which ``where`` is true go; files without one stay as they are."""
        version = self.version()
        schema, files = self._manifest(version)
        hit = {unquote(r["p"]) for r in self._frame(schema, files).where(where).select(F.col("_metadata.file_path").alias("p")).distinct().collect()} if files else set()
        touched = [f for f in files if f.path in hit]
        left = self._placed(self._frame(schema, touched).where(~F.coalesce(where, F.lit(False))), files)
        made = self._written(left, len(touched)) if touched else []
        after = [f for f in files if f.path not in hit] + made
        self._commit(version + 1, schema, after)
        return self._report(version + 1, after, made)
