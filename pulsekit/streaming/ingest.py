"""Z1 — incremental ingest: new export files in a landing folder are picked
up as a file stream and upserted into the post history per micro-batch.

The stream is stateless; the history snapshots are the state (H1 keep-
latest upsert inside ``foreachBatch``).  Progress lives in a checkpoint under
the cluster's shared ``spark.checkpoint.dir``, so a restarted job (or a lost
executor) resumes without re-ingesting or skipping files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsekit.session import ensure_checkpoint_dir
from pulsekit.sources.exports import _header
from pulsekit.sources.history import _fs, merge_posts_into_history
from pulsekit.sources.normalize import normalize_export

INSTAGRAM_EXPORT_COLUMNS = ["Post ID", "Account ID", "Account username", "Account name", "Description",
                            "Duration (sec)", "Publish time", "Permalink", "Post type", "Data comment", "Date",
                            "Views", "Reach", "Likes", "Shares", "Follows", "Comments", "Saves"]


def export_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def landing_columns(spark: SparkSession, landing_dir: str) -> list[str] | None:
    """Columns of the CSV files in a folder; None without any, an error where their headers differ."""
    fs, p = _fs(spark, landing_dir)
    if not fs.exists(p):
        return None
    heads = (spark.read.option("pathGlobFilter", "*.csv").text(landing_dir)
             .select(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("at"))
             .where("block = 0").groupBy("uri").agg(F.min_by("value", "at").alias("line")))
    lines = [r["line"] for r in heads.select("line").distinct().limit(2).collect()]
    if len(lines) > 1:
        raise ValueError(f"files of several layouts in {landing_dir}: name the columns, or give each layout a folder")
    return _header(lines[0]) if lines else None


def start_incremental_ingest(spark: SparkSession, landing_dir: str, history_base: str, platform: str,
                             columns: list[str] | None = None, name: str | None = None,
                             available_now: bool = True, platform_start: dict[str, str] | None = None,
                             checkpoint: str | None = None) -> StreamingQuery:
    """Start the stream: CSV files of one export layout -> N3 normalisation
    -> H1/H3 merge into a new history snapshot per micro-batch.

    Without ``columns`` the layout is that of the files already in the folder; an empty folder has
    Instagram's.  Several layouts need a folder and a stream each.
    """
    columns = columns or landing_columns(spark, landing_dir) or INSTAGRAM_EXPORT_COLUMNS
    name = name or f"ingest_{platform}"
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    src = (spark.readStream.schema(export_schema(columns)).option("header", True).option("multiLine", True)
           .option("enforceSchema", False)      # columns go by the header's names; another order is an error, not a misreading
           .option("pathGlobFilter", "*.csv").csv(landing_dir)
           .withColumn("source_file", F.col("_metadata.file_path")))

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        norm = normalize_export(batch, platform, source_col="source_file").drop("source_file")
        ingested = F.current_timestamp()
        norm = norm.withColumn("_ingested_at", F.to_timestamp_ntz(F.date_format(ingested, "yyyy-MM-dd HH:mm:ss.SSSSSS")))
        merge_posts_into_history(batch.sparkSession, history_base, norm, platform_start=platform_start)

    w = src.writeStream.queryName(name).option("checkpointLocation", ckpt).foreachBatch(upsert)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
