"""Writers for works, vectors and datasets."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.staging import stage


def write_parts(works, metadata_path, vectors_path, mode="overwrite"):
    """Texts and vectors of the works as two tables, by update date.

    The year stands in both, so that vectors can be selected without a join.
    The works are staged first, so that embeddings are computed once. Dates may differ much in size; rebalancing splits large ones and joins
    small ones before the files are written.
    """
    spread = stage(works, "works").hint("rebalance", "updated_date")
    keys = ["updated_date", "part"]
    metadata = spread.select("id", "title", "abstract", "publication_year", *keys)
    metadata.write.mode(mode).partitionBy("updated_date").parquet(metadata_path)
    vectors = spread.select("id", "embedding", "publication_year", *keys)
    vectors.write.mode(mode).partitionBy("updated_date").parquet(vectors_path)


def write_parquet(df, path, mode="overwrite"):
    df.write.mode(mode).parquet(path)


def write_csv(df, path, mode="overwrite"):
    """CSV with a header; list columns as JSON, quotes doubled.

    Null and the empty string are both written as nothing and read as null.
    """
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema
    ]
    options = {"header": True, "quote": '"', "escape": '"', "emptyValue": ""}
    df.select(*flat).write.mode(mode).options(**options).csv(path)


def publish_vectors(embeddings, path, mode="overwrite"):
    embeddings.select("id", "embedding").write.mode(mode).parquet(path)
