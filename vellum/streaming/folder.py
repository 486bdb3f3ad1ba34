"""A watched image folder as a stream; pages are processed batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vellum.sources.images import EXTENSIONS, SCHEMA


def stream_images(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The folder's images as they arrive: the columns of ``scan_images``."""
    glob = "*.{" + ",".join(e for x in EXTENSIONS for e in (x.lower(), x.upper())) + "}"
    return spark.readStream.format("binaryFile").schema(SCHEMA).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).load(folder)


def process_folder(images: DataFrame, step: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Run ``step`` on each batch of images.  A batch that failed runs again whole, so ``step`` has to write in place
    (overwrite by page); pages are independent of one another, so no state is kept."""
    return images.writeStream.foreachBatch(lambda df, _epoch: step(df)).option("checkpointLocation", checkpoint).start()
