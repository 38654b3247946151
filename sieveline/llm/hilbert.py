"""Shards along a Hilbert curve through several metadata dimensions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm.tables import row_hash, running, text_of
from sieveline.staging import join_hot, stage

BITS = 5
ACCURACY = 10_000


def _is_text(docs, name):
    return isinstance(docs.schema[name].dataType, T.StringType)


def _text_levels(docs, name, bits, level):
    """`docs` with a column `level` for a string column: the rank of its value, weighted by rows, in 2**bits levels.

    Distinct values are counted before they are shuffled, and a range sort
    gives the rows before each of them; so names that share a long prefix
    are told apart, and a value of a third of all rows is one row here.
    """
    values = docs.where(docs[name].isNotNull()).groupBy(docs[name].alias("_value")).agg(F.count("*").alias("_n"))
    ranked = stage(running(stage(values, "values"), ["_value"], {"_upto": "_n"}), "ranked")
    total = ranked.agg(F.sum("_n")).first()[0] or 1
    place = F.expr(f"CAST(((_upto - _n) * {2**bits}L) DIV {total}L AS BIGINT)")
    ranked = ranked.select(F.col("_value").alias(name), place.alias(level))
    told = join_hot(docs.where(docs[name].isNotNull()), ranked, name)
    rest = docs.where(docs[name].isNull()).withColumn(level, F.lit(0).cast("long"))
    return told.select(*docs.columns, level).unionByName(rest)


def levels(docs, columns, bits=BITS):
    """(docs, levels): `docs` with one more column for each of `columns`, quantised to 2**bits levels of about as many rows.

    Numbers are cut at approximate percentiles of the whole column, 2**bits - 1 numbers
    of each; strings at the ranks of their values by count. Equal values have equal levels, null and NaN have level 0.
    """
    shares = [n / 2**bits for n in range(1, 2**bits)]
    numbers = [name for name in columns if not _is_text(docs, name)]
    usable = {name: F.when(~F.isnan(docs[name].cast("double")), docs[name].cast("double")) for name in numbers}
    cuts = docs.agg(F.lit(0), *(F.percentile_approx(column, shares, ACCURACY) for column in usable.values())).first()

    def level(column, own):
        return F.size(F.filter(F.array(*map(F.lit, own or [])).cast("array<double>"), lambda cut: cut < column)).cast("long")

    named = {name: f"_level_{n}" for n, name in enumerate(columns)}
    docs = docs.withColumns({named[name]: level(usable[name], cuts[n + 1]) for n, name in enumerate(numbers)})
    for name in columns:
        if name not in numbers:
            docs = _text_levels(docs, name, bits, named[name])
    return docs, [F.col(named[name]) for name in columns]


def curve_index(coordinates, bits=BITS):
    """Index along the Hilbert curve of a point of 2 or more `coordinates`, columns of longs below 2**bits.

    The coordinates are turned into the transposed index (from the highest bit
    down, exchange or invert the lower bits of the first and each other axis;
    then Gray code), whose bits are interleaved, first axis highest.
    """
    n = len(coordinates)
    state = F.array(*coordinates)

    def turn(i, bit, low):
        def axes(a):
            swap = a[0].bitwiseXOR(a[i]).bitwiseAND(low)
            on = a[i].bitwiseAND(bit) != 0
            turned = [a[k] for k in range(n)]
            turned[i] = F.when(on, a[i]).otherwise(a[i].bitwiseXOR(swap))
            turned[0] = F.when(on, a[0].bitwiseXOR(low)).otherwise(a[0].bitwiseXOR(swap))
            return F.array(*turned)

        return axes

    def settle(axes, bit):
        for i in range(n):
            # Each axis rewrites the array; as a lambda's variable it is computed once.
            axes = F.transform(F.array(axes), turn(i, bit, bit - 1))[0]
        return axes

    bits_down = F.array(*(F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)))
    turned = F.aggregate(bits_down, state, settle)

    def gray(a):
        axes = [a[0]]
        for i in range(1, n):
            axes.append(a[i].bitwiseXOR(axes[-1]))
        flip = F.lit(0).cast("long")
        for b in range(1, bits):
            below = F.when(axes[-1].bitwiseAND(F.lit(1 << b).cast("long")) != 0, F.lit((1 << b) - 1).cast("long"))
            flip = flip.bitwiseXOR(F.coalesce(below, F.lit(0).cast("long")))
        return F.transform(F.array(*axes), lambda axis: axis.bitwiseXOR(flip))

    def interleaved(a):
        index = F.lit(0).cast("long")
        for b in range(bits):
            for i in range(n):
                one = F.shiftright(a[i], b).bitwiseAND(F.lit(1).cast("long"))
                index = index + F.shiftleft(one, b * n + n - 1 - i)
        return index

    coded = F.transform(F.array(turned), gray)[0]
    return F.transform(F.array(coded), interleaved)[0]


def shard(docs, dimensions=("lang", "source", "size"), shards=8, bits=BITS):
    """(doc_id, row, size, text_crc32, curve, law, shard, slot) per row of `docs`.

    Rows are sorted by the Hilbert index of their quantised `dimensions` (columns
    of `docs`, or size: UTF-8 bytes of the text plus 1) and cut into `shards`
    runs whose counts differ by one at most; `slot` numbers a shard's rows from
    0. So a shard, or a file of some slots, spans small ranges of all dimensions.

    Null text has size 1 and crc 0; null dimensions have the lowest level; ties
    and equal rows are ordered by doc_id, crc and size. An empty table gives no rows.
    """
    text = text_of(docs).cast("binary")
    size = (F.octet_length(text) + 1).cast("long")
    others = [name for name in dimensions if name != "size"]
    narrow = docs.select(
        docs["doc_id"].alias("_id"), size.alias("_size"), F.crc32(text).alias("_crc"), row_hash(docs).alias("_row"),
        *(docs[name].alias(f"_of_{name}") for name in others),
    )
    narrow = stage(narrow, "sized")
    named = ["_size" if name == "size" else f"_of_{name}" for name in dimensions]
    leveled, coordinates = levels(narrow, named, bits)
    placed = stage(leveled.select("_id", "_size", "_crc", "_row", curve_index(coordinates, bits).alias("_curve")), "curve")
    total = placed.count()
    numbered = running(placed, ["_curve", "_id", "_crc", "_size", "_row"], {}, row="_rank")
    # The first row of shard s is ceil(s * total / shards).
    shard_of = F.expr(f"CAST(_rank * {shards}L DIV {max(total, 1)}L AS INT)")
    start = F.expr(f"(shard * {total}L + {shards - 1}L) DIV {shards}L")
    return numbered.withColumn("shard", shard_of).select(
        F.col("_id").alias("doc_id"), F.col("_row").alias("row"), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.col("_curve").alias("curve"), F.lit("rows").alias("law"), "shard", (F.col("_rank") - start).alias("slot"),
    )


def write_shards(docs, path, slots=100_000, **options):
    """Write `docs` as Parquet below `path`, by shard, in files of `slots` rows that follow the curve.

    The columns of `docs` are kept; `shard`, `slot` are added (and replace columns
    of these names). Readers skip files by the ranges of their columns. Rows
    equal in doc_id and text go to the place of the first of them.
    """
    places = shard(docs, **options).groupBy(F.col("row").alias("_row"), F.col("doc_id").alias("_id"))
    places = places.agg(F.min(F.struct("shard", "slot")).alias("_place"))
    rows = docs.select(F.struct("*").alias("_doc"), docs["doc_id"].alias("_key"), row_hash(docs).alias("_hash"))
    rows = rows.join(places, [F.col("_hash") == F.col("_row"), F.col("_key").eqNullSafe(F.col("_id"))])
    own = {"shard": F.col("_place.shard"), "slot": F.col("_place.slot")}
    placed = rows.select(*(F.col("_doc")[c].alias(c) for c in docs.columns if c not in own), *(c.alias(n) for n, c in own.items()))
    file = F.floor(F.col("slot") / slots)
    placed = placed.repartitionByRange("shard", file).sortWithinPartitions("shard", "slot")
    placed.write.partitionBy("shard").option("maxRecordsPerFile", slots).parquet(path)
