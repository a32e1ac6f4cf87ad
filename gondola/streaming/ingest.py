"""Ingest of a folder of monthly files into the knowledge base, in one go or as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.knowledge import chunks_of_parts, kb_chunks, month_parts
from ..sources.readers import last_file_parts, read_last_files, with_month_from_filename
from ..sources.sinks import upsert_months


def replace_months(spark: SparkSession, folder: str, kb_path: str,
                   months: DataFrame | None = None, key: str = "name") -> None:
    """Replace the chunks of the given months, or of all, from the folder as it stands.

    A month's chunks come from all parts of its last file by name, whichever part or
    file gave the occasion. Doing it again gives the same chunks.
    """
    upsert_months(kb_chunks(read_last_files(spark, folder, months), key), kb_path)


def stream_ingest(spark: SparkSession, folder: str, kb_path: str, checkpoint: str,
                  by_folder: bool = False, max_files: int | None = None,
                  key: str = "name") -> StreamingQuery:
    """Ingest the files that are new since the last run, then stop.

    Reads plain ``sales_*.csv`` files, or with ``by_folder`` the month folders of
    ``write_monthly``. A new file is opened once: what it gives to its month is kept in sums
    per file, and a month's chunks are merged from the sums of all parts that its last file
    by name has at the time. So a part costs its own rows, it doesn't matter how files are
    spread over batches, and a batch that is done again replaces its own sums. ``checkpoint``
    holds the list of files done and their sums; keep it on the shared folder.
    """
    fields = list(schemas.PLANOGRAM.fields)
    reader = spark.readStream.option("header", True)
    if by_folder:
        fields.append(T.StructField("source_file", T.StringType()))
    else:
        reader = reader.option("pathGlobFilter", "sales_*.csv")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.schema(T.StructType(fields)).csv(folder)
    stream = stream.withColumn("part", F.col("_metadata.file_path"))
    if not by_folder:
        stream = stream.withColumn("source_file", F.col("_metadata.file_name"))

    def ingest(batch: DataFrame, number: int) -> None:
        session, sums = batch.sparkSession, f"{checkpoint}/parts"
        rows = with_month_from_filename(batch, strict=True).persist()
        own = month_parts(rows, key)
        own.write.mode("overwrite").partitionBy("month_key").parquet(f"{sums}/batch={number}")
        news = [r["month_key"] for r in rows.select("month_key").distinct().collect()]
        rows.unpersist()
        if not news:
            return
        parts = (session.read.schema(own.schema).option("basePath", sums).parquet(sums)
                 .filter(F.col("month_key").isin(news))
                 .join(last_file_parts(session, folder, news),
                       ["month_key", "source_file", "part"], "left_semi"))
        upsert_months(chunks_of_parts(parts), kb_path)

    return (stream.writeStream.foreachBatch(ingest)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
