"""Incremental ingest of newly arrived part files."""

from pyspark.sql import types as T

from sieveline.sources.readers import RAW_WORK, dated, prepare_works, with_part

PREPARED = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("id", "title", "abstract")]
    + [T.StructField("publication_year", T.IntegerType())]
    + [T.StructField(name, T.StringType()) for name in ("part", "updated_date")]
)


def ingest_stream(spark, folder, output, checkpoint, schema=RAW_WORK, pattern="part_*.gz", embed=None):
    """Start a query that processes all part files not processed before.

    It ends when the files present are done; the file sink and the checkpoint
    make each file count once even if the job is restarted. `embed` may add
    an embedding column.
    """
    raw = spark.readStream.schema(dated(schema)).option("pathGlobFilter", pattern).json(folder)
    works = prepare_works(with_part(raw))
    works = embed(works) if embed else works
    return (
        works.writeStream.format("parquet")
        .partitionBy("updated_date")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(output)
    )
