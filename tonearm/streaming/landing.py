"""Each arriving monthly listen file is converted once, as a stream of files.

The batch job skips months that are already landed; here the stream's own
checkpoint remembers which files were taken, so a restarted or repeated run
goes on where the last one stopped and no file is landed twice.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_LISTEN
from ..sources.listens import message_id


def land_new_listens(spark: SparkSession, root: str, target: str, checkpoint: str, max_files: int = 64):
    """Land all files not taken so far into ``target`` (Parquet, one folder per month); returns the query.

    The query stops by itself once the folder is drained. No state is kept:
    rows stay where they were read, a large file is not regrouped.
    """
    raw = spark.readStream.schema(RAW_LISTEN).option("maxFilesPerTrigger", max_files).option("pathGlobFilter", "*.listens*").json(root)
    month = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.", 1).cast("int")
    listens = raw.select("user_id", message_id().alias("recording_msid"), month.alias("month"))
    return (
        listens.dropna(subset=["user_id", "recording_msid"])
        .writeStream.format("parquet")
        .partitionBy("month")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start(target)
    )
