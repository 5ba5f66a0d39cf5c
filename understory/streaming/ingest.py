"""Segments from point batches that arrive over time.

Distinct voxels, distinct layers and the highest point of a segment are mergeable, so each
micro-batch adds its partial relations to a folder, in a place of its own: a batch that is
run again writes the same place.  Merging reads all partials.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from understory.functions.aggregates import arg_max
from understory.operators import segments
from understory.params import Parameters


class SegmentIngest:
    """Partial segment relations in a folder that all executors share."""

    def __init__(self, folder: str, p: Parameters):
        self.folder, self.p = folder.rstrip("/"), p

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Write the partials of long points (pid, x, y, h and segment keys)."""
        rows = segments.valid(batch, self.p).persist()
        parts = {
            "voxels": segments.voxels(rows, self.p),
            "layers": segments.layers(rows),
            "apexes": arg_max(rows, segments.KEYS, "h", ["pid", "x", "y"], {"pid": "pid", "x": "x", "y": "y", "h": "h"}),
        }
        for name, part in parts.items():
            part.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={batch_id}")
        rows.unpersist()

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Ingest all of a stream that is there, batch by batch."""
        return stream.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def _all(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/{name}").drop("batch")

    def segments(self, spark: SparkSession) -> DataFrame:
        """(keys, apex_x, apex_y, apex_z, n_vox, n_occupied_layers) of all batches so far."""
        apex = segments.apexes(self._all(spark, "apexes"))
        vox = segments.counts(self._all(spark, "voxels").distinct(), self.p).drop("voxel_volume")
        lay = segments.layer_totals(self._all(spark, "layers").distinct())
        return segments.merge([apex, vox, lay])


def heights_by_window(stream: DataFrame, time: str, watermark: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """(window, n, height_max, height_mean) of timed points; late ones count until the watermark passes."""
    timed = stream.withWatermark(time, watermark).groupBy(F.window(time, window))
    return timed.agg(F.count("*").alias("n"), F.max("h").alias("height_max"), F.avg("h").alias("height_mean"))


def state_folder(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir; a temporary one only where that is unset on one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="understory-")
    return f"{shared.rstrip('/')}/understory/stream-{uuid.uuid4().hex}"
