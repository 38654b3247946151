"""Column expressions over identifiers and texts."""

from pyspark.sql import functions as F

from sieveline.settings import ENCODER_PREFIX, ID_PREFIX


def short_id(col, prefix=ID_PREFIX):
    """Identifier without its URL prefix; only a leading prefix is removed."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col.startswith(prefix), F.substring(col, len(prefix) + 1, 2**31 - 1)).otherwise(col)


def full_id(col, prefix=ID_PREFIX):
    return F.concat(F.lit(prefix), col)


def rebuild_abstract(index):
    """Text of an inverted index `map<token, positions>`.

    Tokens are ordered by position, equal positions by the order of the map;
    a null index or an empty text gives null.
    """
    index = F.col(index) if isinstance(index, str) else index
    # One long per token, position above and place in the map below, sorts
    # several times faster than a struct.
    placed = F.transform(
        F.map_values(index),
        lambda positions, n: F.transform(positions, lambda pos: F.shiftleft(pos.cast("long"), 32) + n),
    )
    tokens = F.transform(
        F.sort_array(F.flatten(placed)),
        lambda packed: F.get(F.map_keys(index), packed.bitwiseAND(F.lit(2**32 - 1)).cast("int")),
    )
    return F.nullif(F.array_join(tokens, " "), F.lit(""))


def has_text(title="title", abstract="abstract"):
    """A work with a title or an abstract; an empty string counts as present."""
    return F.col(title).isNotNull() | F.col(abstract).isNotNull()


def document_text(title="title", abstract="abstract"):
    """Title and abstract with one space between, missing parts empty."""
    return F.concat(
        F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.coalesce(F.col(abstract), F.lit(""))
    )


def encoder_text(text, prefix=ENCODER_PREFIX):
    text = F.col(text) if isinstance(text, str) else text
    return text if prefix is None else F.concat(F.lit(prefix), text)


def restore_hyphens(col):
    """Replace the control character \\x02 left by PDF extraction with `-`."""
    return F.replace(F.col(col), F.lit("\x02"), F.lit("-"))


def matches_doi(col, dois, regex=False):
    """True where a DOI contains one of `dois`, whatever the case; null is false.

    With `regex` each entry is a pattern, so `.` matches any character.
    """
    text = F.lower(F.coalesce(F.col(col), F.lit("")))
    found = F.lit(False)
    for doi in dois:
        found = found | (text.rlike(doi.lower()) if regex else text.contains(doi.lower()))
    return found


def numeric_suffix(col):
    """The number in an identifier of the form `M123`."""
    return F.substring(F.col(col), 2, 2**31 - 1).cast("long")


def master_id(number):
    return F.concat(F.lit("M"), number.cast("string"))


def nan_to_null(col):
    return F.nanvl(F.col(col), F.lit(None))


def partition_value(path, key="updated_date"):
    """Value of a `key=value` folder in a file path."""
    return F.regexp_extract(path, rf"{key}=([^/]+)/", 1)


def part_number(path):
    """Part label of a file named `<name>_<label>.<extension>`."""
    return F.regexp_extract(path, r"_([^_./]+)(?:\.[^/]*)?$", 1)
