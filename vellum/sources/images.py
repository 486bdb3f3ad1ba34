"""Image folders as DataFrames."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: extensions that count as images, in lower or in upper case.
EXTENSIONS = ("jpg", "jpeg", "png", "gif", "bmp", "tiff", "tif", "webp")
SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def scan_images(spark: SparkSession, folder: str, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """path, modificationTime, length, content of a folder's images, not of folders in it; extensions in all lower or all
    upper case.  Files whose name begins with a dot, and empty files, are passed over; those beginning with an underscore, which
    Spark hides, are read by name.  Sort by path where an order is wanted."""
    glob = "*.{" + ",".join(e for x in extensions for e in (x.lower(), x.upper())) + "}"
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    hidden = [os.path.join(folder, n) for n in sorted(os.listdir(folder)) if n.startswith("_") and n.rsplit(".", 1)[-1] in {e for x in extensions for e in (x.lower(), x.upper())}] if os.path.isdir(folder) else []
    out = reader.load(folder)
    return out.unionByName(_read_files(spark, hidden)) if hidden else out


def _read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The named files, read where the rows are: for folders that the executors can reach by the same path."""

    def run(batches):
        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                with open(path, "rb") as f:
                    content = f.read()
                rows.append((f"file:{path}", pd.Timestamp(int(os.path.getmtime(path)), unit="s"), len(content), content))
            yield pd.DataFrame(rows, columns=["path", "modificationTime", "length", "content"])

    return spark.createDataFrame([(p,) for p in paths], "path STRING").mapInPandas(run, SCHEMA)


def decode_images(images: DataFrame, sizes_only: bool = True) -> DataFrame:
    """path, height, width, pixels (rows of RGB; NULL if ``sizes_only``), error: one bad file is one row with an error."""
    from vellum.functions.raster import decode

    def run(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    px = decode(bytes(content))
                    rows.append((path, px.shape[0], px.shape[1], None if sizes_only else px.tobytes(), None))
                except Exception as e:  # noqa: BLE001 - the error is the row's result
                    rows.append((path, None, None, None, str(e)[:200]))
            yield pd.DataFrame(rows, columns=["path", "height", "width", "pixels", "error"]).astype({"height": "Int32", "width": "Int32"})

    return images.select("path", "content").mapInPandas(run, "path STRING, height INT, width INT, pixels BINARY, error STRING")


def with_page_ids(images: DataFrame) -> DataFrame:
    """Adds page_id (a hash of the path, so that it stays the same) and img_name."""
    return images.withColumn("page_id", F.xxhash64("path")).withColumn("img_name", F.element_at(F.split("path", "/"), -1))
