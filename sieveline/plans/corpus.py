"""From part files to the text and vector tables, and to the vectors searched."""

from sieveline.functions.text import document_text
from sieveline.operators import embedding
from sieveline.operators.feed import keep_latest, recent, split_valid
from sieveline.settings import MIN_YEAR, VECTOR_DIM
from sieveline.sources.readers import RAW_WORK, prepare_works, read_works
from sieveline.sources.writers import write_parts


def embed_works(works, embed=embedding.embed):
    """Embedding of title and abstract; `embed` takes a table with `text`."""
    return embed(works.withColumn("text", document_text())).drop("text")


def build(spark, folder, texts, vectors, pattern="part_*.gz", schema=RAW_WORK, embed=embedding.embed):
    """Read all part files, embed the works and write both tables."""
    works = prepare_works(read_works(spark, folder, schema, pattern))
    write_parts(embed_works(works, embed), texts, vectors)


def searchable(vectors, metadata=None, min_year=MIN_YEAR, dim=VECTOR_DIM):
    """The vectors to search, one per work, and the rows refused with a reason.

    Only versions from `min_year` on count, so an older one stays if the
    latest is out.
    """
    accepted, refused = split_valid(recent(vectors, metadata, min_year), dim)
    return keep_latest(accepted), refused
