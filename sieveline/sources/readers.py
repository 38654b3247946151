"""Readers for works, vectors, reviews and result tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions.text import has_text, nan_to_null, part_number, rebuild_abstract, short_id

RAW_WORK = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract_inverted_index", T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))),
        T.StructField("publication_year", T.IntegerType()),
    ]
)
FULL_WORK = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("doi", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract_inverted_index", T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))),
        T.StructField("referenced_works", T.ArrayType(T.StringType())),
        T.StructField("publication_date", T.DateType()),
    ]
)
REVIEW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("doi", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("label_included", T.IntegerType()),
    ]
)


def read_works(spark, folder, schema=RAW_WORK, pattern="part_*.gz"):
    """JSON-lines works below `updated_date=` folders, with their part label.

    A gzip file is read by one task. Where there are fewer files than cores, or
    one is much larger than the others, rows are dealt anew by size once parsed.
    """
    works = with_part(spark.read.schema(dated(schema)).option("pathGlobFilter", pattern).json(folder))
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    sizes = files.load(folder).agg(F.count("*").alias("n"), F.max("length").alias("most"), F.avg("length").alias("mean")).first()
    uneven = sizes.n and (sizes.n < spark.sparkContext.defaultParallelism or sizes.most > 4 * sizes.mean)
    return works.hint("rebalance") if uneven else works


def dated(schema):
    """Schema with the folder column, by which Spark prunes whole folders."""
    return T.StructType([*schema.fields, T.StructField("updated_date", T.StringType())])


def with_part(raw):
    return raw.withColumn("part", part_number(F.col("_metadata.file_path")))


def prepare_works(raw):
    """Short id and abstract text of all works that have a title or an abstract."""
    told = raw.withColumn("abstract", rebuild_abstract("abstract_inverted_index"))
    return told.filter(has_text()).withColumn("id", short_id("id")).drop("abstract_inverted_index")


def read_parquet_parts(spark, folder, pattern="*.parquet"):
    """Parquet files below a folder; `key=value` folders are columns, by which whole folders are pruned."""
    return spark.read.option("pathGlobFilter", pattern).parquet(folder)


def read_csv(spark, path, schema):
    """CSV with a header and quoted fields that may hold quotes and newlines.

    Columns are taken by name, so files may have more or in another order. Whole
    numbers may be written with a decimal point, as nullable columns are. A
    field that cannot be read as its type fails the query that reads it.
    """
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
    names = spark.read.options(**options).csv(path).columns
    every = T.StructType([T.StructField(name, T.StringType()) for name in names])
    table = spark.read.options(**options).schema(every).csv(path)
    missing = [field.name for field in schema if field.name not in names]
    if missing:
        raise ValueError(f"{path} has no columns {missing}")
    return table.select(*[_parsed(field) for field in schema])


def _parsed(field):
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        value = F.from_json(text, field.dataType)
    elif isinstance(field.dataType, T.IntegralType):
        number = text.try_cast(T.DecimalType(38, 9))
        value = F.when(number == F.floor(number), number.try_cast(field.dataType))
    else:
        value = text.try_cast(field.dataType)
    wrong = F.concat(F.lit(f"{field.name} is not {field.dataType.simpleString()}: "), text)
    failed = text.isNotNull() & value.isNull()
    return F.when(failed, F.raise_error(wrong).cast(field.dataType)).otherwise(value).alias(field.name)


def read_master(spark, path, schema):
    """Master table from CSV or Parquet, by the ending of the path."""
    if str(path).endswith(".csv"):
        return read_csv(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def read_vector(spark, path):
    """One-row table `embedding` from a JSON file holding one array of numbers."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", T.ArrayType(T.DoubleType())).cast("array<float>").alias("embedding"))


def literal_table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def clean_floats(df):
    """NaN to null in every floating-point column."""
    names = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({name: nan_to_null(name) for name in names})
