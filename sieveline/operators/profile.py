"""Corpus counts and column profiles in one pass."""

from pyspark.sql import functions as F

from sieveline.settings import MIN_YEAR


def corpus_counts(works, min_year=MIN_YEAR):
    recent = F.col("publication_year") >= min_year
    told = F.col("abstract").isNotNull()
    return works.agg(
        F.count("*").alias("n_works"),
        F.count_if(told).alias("n_abstract"),
        F.count_if(recent).alias("n_recent"),
        F.count_if(recent & told).alias("n_recent_abstract"),
    )


def column_profile(df):
    """Per column its type, the number of rows and that of non-null values."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_{n}") for n, c in enumerate(df.columns)]
    )
    rows = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.col("_rows").alias("n_rows"),
            F.col(f"_{n}").alias("n_values"),
        )
        for n, field in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*rows)))
