"""CSV with a declared schema (with or without header) or inferred.

CSV columns are nullable whatever a schema declares, and unparsable values
become NULL in the default PERMISSIVE mode. Inference costs a full extra pass
over the data, so jobs should declare schemas; ``infer=True`` is offered for
exploration only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The three input schemas, in the files' column order.

# Ratings: user, item, rating, rating id (no header).
RATINGS_SCHEMA = T.StructType([
    T.StructField("UserID", T.IntegerType(), False),
    T.StructField("MovieID", T.IntegerType(), True),
    T.StructField("Rating", T.FloatType(), True),
    T.StructField("RatingID", T.IntegerType(), True),
])

# Items with a '|'-separated tag string (no header).
ITEMS_SCHEMA = T.StructType([
    T.StructField("MovieID", T.IntegerType(), False),
    T.StructField("MovieTitle", T.StringType(), True),
    T.StructField("Genres", T.StringType(), True),
])

# Set-valued profile rows (with header). Decimal columns are declared wide
# enough to keep fractions instead of the 10,0 default, which rounds them.
PROFILE_SCHEMA = T.StructType([
    T.StructField("_c0", T.IntegerType(), False),
    T.StructField("id", T.IntegerType(), False),
    T.StructField("numports", T.IntegerType(), False),
    T.StructField("lifetime", T.DecimalType(18, 6), False),
    T.StructField("Bytes", T.IntegerType(), False),
    T.StructField("Packets", T.IntegerType(), False),
    T.StructField("average_packetsize", T.IntegerType(), False),
    T.StructField("average_lifetime", T.DecimalType(18, 6), False),
    T.StructField("MinUniqueDests", T.IntegerType(), False),
    T.StructField("MaxUniqueDests", T.IntegerType(), False),
    T.StructField("MinUniqueDest24s", T.IntegerType(), False),
    T.StructField("MaxUniqueDest24s", T.IntegerType(), False),
    T.StructField("mirai", T.BooleanType(), True),
    T.StructField("zmap", T.BooleanType(), True),
    T.StructField("masscan", T.BooleanType(), True),
    T.StructField("country", T.StringType(), False),
    T.StructField("traffic_types_scanned_str", T.StringType(), False),
    T.StructField("ports_scanned_str", T.StringType(), False),
    T.StructField("host_tags_per_censys", T.StringType(), False),
    T.StructField("host_services_per_censys", T.StringType(), False),
])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = False,
    infer: bool = False,
) -> DataFrame:
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


# The lattice of column types, narrowest first: (type, what a value must look
# like, whether the cast must also succeed). Every value is a string.
_LATTICE = (
    ("boolean", r"^(?i:true|false)$"),
    ("int", r"^[+-]?[0-9]+$"),
    ("bigint", r"^[+-]?[0-9]+$"),
    ("double", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"),
)


def column_types(raw: DataFrame) -> DataFrame:
    """What the string columns of ``raw`` hold, from one pass: (position,
    column, type, rows, null_share, misfit).

    ``type`` is the narrowest of boolean, int, bigint, double, date and timestamp
    that takes every value (int goes into bigint and double), else string; a
    column without values is a string. NULL and empty strings are NULLs. ``misfit``
    is the least value that the next narrower of the numbers does not take, or for
    a string the least that is no number (NULL: there is none).
    """
    aggs, names = [F.count(F.lit(1)).alias("rows")], raw.columns
    for i, c in enumerate(names):
        v = F.when(F.col(c) != "", F.col(c))
        fits = {t: v.rlike(pattern) & v.try_cast(t).isNotNull() for t, pattern in _LATTICE}
        aggs.append(F.struct(
            F.count(v).alias("n"),
            *[F.coalesce(F.every(F.when(v.isNotNull(), ok)), F.lit(False)).alias(t) for t, ok in fits.items()],
            *[F.min(F.when(~fits[t], v)).alias(f"no_{t}") for t in ("int", "bigint", "double")]).alias(f"c{i}"))
    one = raw.agg(*aggs)
    out = []
    for i, c in enumerate(names):
        s = F.col(f"c{i}")
        kind, misfit = F.lit("string"), s["no_double"]
        for t, _ in reversed(_LATTICE):
            kind = F.when(s[t], F.lit(t)).otherwise(kind)
        misfit = F.when(kind == "bigint", s["no_int"]).when(kind == "double", s["no_bigint"]).when(
            kind == "string", s["no_double"])
        out.append(F.struct(
            F.lit(i).alias("position"), F.lit(c).alias("column"), kind.alias("type"), F.col("rows"),
            F.coalesce(F.try_divide(F.col("rows") - s["n"], F.col("rows")), F.lit(0.0)).alias("null_share"),
            misfit.alias("misfit")))
    return one.select(F.inline(F.array(*out)))


def infer_schema(spark: SparkSession, path: str, header: bool = False) -> T.StructType:
    """The schema of :func:`column_types` for CSV files: one pass over them."""
    raw = spark.read.option("header", header).csv(path)
    kinds = {r["position"]: r["type"] for r in column_types(raw).collect()}  # a row per column
    return T.StructType([T.StructField(c, T._parse_datatype_string(kinds[i])) for i, c in enumerate(raw.columns)])
