"""SRC-08: incremental ingest of vacancy files with Structured Streaming.

New raw files in a folder are found as a stream; the *stateless* part of the
preparation (title filter, null markers, weight, dates, span end and
duration, validity filters) runs per micro-batch and the rows are appended
to a Parquet table. ``trigger(availableNow=True)`` processes what is there
and stops, so the same job serves as a repeatable batch catch-up; the
checkpoint makes a restarted job continue where it stopped, and the
file-source log gives each file exactly once to the sink.

Encodings need statistics over all rows and stay in the batch stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import PrepConfig
from ..plans.prepare import clean_rows
from ..sources.vacancies import read_raw

STATELESS_COLUMNS = ("vacancy_id", "title", "industry", "work_places", "date_creation_processed",
                     "date_end", "vacancy_duration")

# What the file source says of a file; only the path is asked for, so no content is read.
FILES = "path string, modificationTime timestamp, length long, content binary"


def prepare_stateless(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    """The row-local preparation steps and filters, in the batch order."""
    return clean_rows(df, cfg, STATELESS_COLUMNS)


def start_ingest(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                 cfg: PrepConfig | None = None, max_files_per_trigger: int | None = None):
    """Start the incremental job; returns the ``StreamingQuery``. A sink belongs to one checkpoint, whose batch ids name its folders.

    The stream carries the new files' paths only; each micro-batch reads its files as a batch
    job does, so columns are matched by name, quoted fields may go over line ends, and a
    file without the needed columns fails the batch. Date forms are inferred per micro-batch
    unless the configuration states them.
    """
    cfg = cfg or PrepConfig()
    reader = spark.readStream.format("binaryFile").schema(FILES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def append(batch: DataFrame, batch_id: int) -> None:
        # as many paths as the source lists for this micro-batch anyway
        paths = sorted(r["path"] for r in batch.collect())
        if paths:
            rows = prepare_stateless(read_raw(batch.sparkSession, paths, multiline=cfg.multiline), cfg)
            # a batch that is repeated after a failure replaces its own folder
            rows.write.mode("overwrite").parquet(f"{sink_dir}/_batch={batch_id}")

    return (reader.load(source_dir).select("path").writeStream.foreachBatch(append)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())


def ingest_available(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                     cfg: PrepConfig | None = None, **kw) -> DataFrame:
    """Run the incremental job over everything available and read the sink."""
    q = start_ingest(spark, source_dir, sink_dir, checkpoint_dir, cfg, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink_dir)
