"""Readers with fixed schemas; ``path`` may be a folder, a file or a glob.

Values of known fields are read as text and cast. A value that its type cannot hold, an
amount with too many decimals among them, stops the job that reads it and is named in
the error, unless ``invalid="null"`` takes it as missing; :func:`invalid_values` counts
such values beforehand.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.feature import StandardScalerModel
from pyspark.mllib.clustering import KMeansModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.operators.rfm import METRICS, Thresholds

OTHER_FIELDS = "other_fields"


def read_tickets(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    further: str | T.StructType | None = None,
    ignore: Sequence[str] = (),
    invalid: str = "raise",
) -> DataFrame:
    """Ticket lines with every field of the source, as lines count as equal only if all agree.

    JSON is read once. Fields beyond the known ones are kept together as ``other_fields``,
    JSON text in one form for equal content: keys in order, numbers without
    idle zeros, null fields left out (null if none is left). ``further`` (a schema, empty
    for none) reads such fields as columns of their own instead. A line that holds no JSON object is a row without fields whose
    ``other_fields`` is the line; a line that is an array of objects is a row for each.
    Fields in ``ignore`` are left out, and so out of the comparison. Parquet or ORC
    instead of JSON gives all columns, and lets later steps read single ones.
    """
    if fmt == "json" and further is None:
        return _read_lines(spark, path, schemas.TICKETS, invalid, ignore)
    return _read(spark, path, schemas.TICKETS, fmt, invalid, further, ignore)


def read_customers(spark: SparkSession, path: str, fmt: str = "json", invalid: str = "raise") -> DataFrame:
    return _read(spark, path, schemas.CUSTOMERS, fmt, invalid, "")


def read_stores(spark: SparkSession, path: str, fmt: str = "json", invalid: str = "raise") -> DataFrame:
    return _read(spark, path, schemas.STORES, fmt, invalid, "")


def read_products(spark: SparkSession, path: str, fmt: str = "json", invalid: str = "raise") -> DataFrame:
    return _read(spark, path, schemas.PRODUCTS, fmt, invalid, "")


def invalid_values(
    spark: SparkSession, path: str, schema: T.StructType = schemas.TICKETS, fmt: str = "json"
) -> dict[str, int]:
    """How many values of each field its type cannot hold, over the whole source."""
    raw = _raw(spark, path, schema, fmt, "")
    counts = [
        F.count_if(F.col(f.name).isNotNull() & _cast(f, raw.schema).isNull()).alias(f.name)
        for f in schema
        if f.name in raw.columns
    ]
    return raw.agg(*counts).first().asDict()


def read_classification(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line, all columns text and found by their names."""
    return spark.read.option("header", True).csv(path).select(*schemas.CLASSIFICATION.names)


def read_predictions(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schemas.PREDICTIONS).format(fmt).load(path)


def read_thresholds(spark: SparkSession, path: str) -> Thresholds:
    """Quartiles of each metric, ascending as numbers."""
    rows = spark.read.schema(schemas.THRESHOLDS).parquet(path).collect()
    found = {row["metric"]: sorted([row["q1"], row["q2"], row["q3"]]) for row in rows}
    return {m: found[m] for m in METRICS}


def read_threshold_folders(spark: SparkSession, path: str) -> Thresholds:
    """Quartiles from three CSV folders without headers, one number on each line."""
    return {
        m: [
            row["q"]
            for row in spark.read.schema("q double")
            .csv(f"{path}/{m[0]}_quartile")
            .orderBy(F.asc("q"))
            .collect()
        ]
        for m in METRICS
    }


def read_centroids(spark: SparkSession, path: str) -> list[list[float]]:
    """Cluster centres of a saved K-Means model, in the order of their indexes."""
    model = KMeansModel.load(spark.sparkContext, path)
    return [[float(x) for x in center] for center in model.clusterCenters]


def read_scaler(path: str) -> StandardScalerModel:
    return StandardScalerModel.load(path)


def _read_lines(
    spark: SparkSession, path: str, schema: T.StructType, invalid: str, ignore: Sequence[str]
) -> DataFrame:
    """Lines of JSON, see :func:`read_tickets`.

    Plain lines are told by :func:`_plain` and read as they are. All others are parsed as a
    VARIANT, which costs several times as much; a plain line would give the same there. That
    part is made of lambdas, so that the code compiled for plain lines is small.
    """
    _check_invalid(invalid)
    blank = F.trim("line", F.lit(" \t\r\n")) == ""
    lines = spark.read.text(path).select(F.col("value").alias("line")).where(~blank)
    start = _start(schema)
    exact = F.col("line").rlike(rf"{start}\}}\z")
    told = lines.select("line", exact.alias("exact"))
    behind = F.regexp_extract("line", rf"{start}(?<=,)({_further(schema, ignore)}\}})\z", 1)
    told = told.select("*", F.when(~F.col("exact"), behind).alias("behind"))
    told = told.select("*", _plain("exact", "behind").alias("plain"))
    own = F.from_json("line", schema, {"allowNonNumericNumbers": "false"})
    rows = told.select(
        "plain",
        "behind",
        F.when(F.col("plain"), own).alias("own"),
        F.when(~F.col("plain"), _typed(_parsed(F.col("line"), schema, ignore), schema)).alias("parsed"),
    )
    each = rows.select("plain", "behind", "own", F.explode_outer("parsed").alias("each"))
    other = F.when(F.col("plain"), F.concat(F.lit("{"), F.col("behind"))).otherwise(F.col(f"each.{OTHER_FIELDS}"))
    return each.where(F.col("plain") | F.col("each").isNotNull()).select(
        *[
            F.when(F.col("plain"), F.col("own")[f.name]).otherwise(_valid(f, invalid)).alias(f.name)
            for f in schema
            if f.name not in ignore
        ],
        other.alias(OTHER_FIELDS),
    )


# Values of plain lines: what JSON's readers take as it is, and whose text is that of its VARIANT.
_WHOLE = r"(?:0|-?[1-9][0-9]{0,16}+)"
_NUMBER = r"(?:-(?=[0-9.]*[1-9]))?+(?:0|[1-9][0-9]{0,16}+)(?:\.[0-9]{1,10}+)?+"
_TEXT = r'"[ !#-\[\]-~\p{L}]*+"'
_PLAIN_VALUES = {"bigint": _WHOLE, "double": _NUMBER, "string": _TEXT}


def _plain_value(field: T.StructField) -> str:
    """Pattern of the values of a field; one that matches nothing for types without plain values."""
    if field.dataType == schemas.AMOUNT:
        return _NUMBER
    return _PLAIN_VALUES.get(field.dataType.simpleString(), "(?!)")


def _start(schema: T.StructType) -> str:
    """Pattern of the known fields of a plain line: each at most once, in the order of the
    schema, without blanks, and what follows is another field or the end of the line's object."""
    fields = [rf'(?:"{re.escape(f.name)}":{_plain_value(f)}(?:,(?=")|(?=\}})))?+' for f in schema]
    return rf"\A\{{{''.join(fields)}"


def _further(schema: T.StructType, ignore: Sequence[str]) -> str:
    """Pattern of one field that is not known, a whole number or a text without escapes."""
    names = "|".join(re.escape(name) for name in (*schema.names, *ignore))
    return rf'"(?!(?:{names})")\w++":(?:{_WHOLE}|"[A-Za-z][A-Za-z0-9 _.:-]*+")'


def _plain(exact: str, behind: str) -> Column:
    """True for a line of known fields alone, or with one plain field behind them."""
    return F.col(exact) | (F.col(behind) != "")


def _parsed(line: Column, schema: T.StructType, ignore: Sequence[str]) -> Column:
    """The rows of any line, from its VARIANT: known fields as text, and the others."""
    texts = T.StructType([T.StructField(name, T.StringType()) for name in schema.names])
    whole = F.array(F.try_parse_json(line))
    items = F.flatten(
        F.transform(whole, lambda w: F.coalesce(F.try_variant_get(w, "$", "array<variant>"), F.array(w)))
    )
    split = F.transform(
        items,
        lambda item: F.struct(item.alias("item"), F.try_variant_get(item, "$", "map<string,variant>").alias("fields")),
    )
    # Keys that come twice, and the like, are no VARIANT, but known fields can be read.
    return F.transform(
        split,
        lambda x: F.struct(
            F.when(x["fields"].isNull(), F.from_json(line, texts))
            .otherwise(F.struct(*[F.try_variant_get(x["item"], f"$.{c}", "string").alias(c) for c in schema.names]))
            .alias("known"),
            F.when(x["fields"].isNull(), line)
            .otherwise(_canonical(x["fields"], {*schema.names, *ignore}))
            .alias(OTHER_FIELDS),
        ),
    )


def _typed(rows: Column, schema: T.StructType) -> Column:
    """:func:`_parsed` rows with known values in their types, and what is ``said`` of a value
    that its type does not hold."""

    def typed(row: Column) -> Column:
        known = [(f, row["known"][f.name], _cast_value(f, row["known"][f.name], T.StringType())) for f in schema]
        return F.struct(
            F.struct(*[cast.alias(f.name) for f, _, cast in known]).alias("known"),
            F.struct(
                *[F.when(value.isNotNull() & cast.isNull(), _complaint(f, value)).alias(f.name) for f, value, cast in known]
            ).alias("said"),
            row[OTHER_FIELDS].alias(OTHER_FIELDS),
        )

    return F.transform(rows, typed)


def _valid(field: T.StructField, invalid: str) -> Column:
    """The value of a field of a :func:`_typed` row, which stops the job if something is said of it."""
    value, said = F.col("each.known")[field.name], F.col("each.said")[field.name]
    if invalid == "null":
        return value
    return F.when(said.isNull(), value).otherwise(F.raise_error(said).cast(field.dataType))


def _canonical(fields: Column, without: set[str]) -> Column:
    """JSON text of a map of VARIANT values, the same for equal content."""
    texts = F.transform_values(
        F.map_filter(fields, lambda k, _: ~k.isin(*sorted(without))),
        lambda _, value: F.regexp_replace(F.to_json(value), r"^(-?[0-9]+)\.0$", "$1"),
    )
    kept = F.array_sort(F.map_entries(F.map_filter(texts, lambda _, text: text != "null")))
    quoted = F.transform(
        kept,
        lambda e: F.concat(
            F.lit('"'), F.replace(F.replace(e["key"], F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')),
            F.lit('":'), e["value"],
        ),
    )
    return F.when(F.size(kept) > 0, F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}")))


def _check_invalid(invalid: str) -> None:
    if invalid not in ("raise", "null"):
        raise ValueError(f"invalid is 'raise' or 'null', not {invalid!r}")


def _read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str,
    invalid: str,
    further: str | T.StructType | None,
    ignore: Sequence[str] = (),
) -> DataFrame:
    _check_invalid(invalid)
    raw = _raw(spark, path, schema, fmt, further)
    others = [c for c in raw.columns if c not in schema.names and c not in ignore]
    known = [
        _checked(f, raw.schema, invalid).alias(f.name)
        if f.name in raw.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
        if f.name not in ignore
    ]
    return raw.select(*known, *[F.col(f"`{c}`") for c in others])


def _raw(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str, further: str | T.StructType | None
) -> DataFrame:
    """The source with all its fields; a text format gives the known ones as text."""
    if fmt != "json":
        found = spark.read.format(fmt).load(path)
        return found if further is None else found.select(*[c for c in found.columns if c in schema.names])
    if not isinstance(further, T.StructType):
        further = T.StructType.fromDDL(further) if further else T.StructType()
    others = [f for f in further if f.name not in schema.names]
    texts = [T.StructField(name, T.StringType()) for name in schema.names]
    return spark.read.schema(T.StructType([*texts, *others])).json(path)


def _cast(field: T.StructField, given: T.StructType) -> Column:
    return _cast_value(field, F.col(field.name), given[field.name].dataType)


def _cast_value(field: T.StructField, value: Column, given: T.DataType) -> Column:
    """The field in its type; null where the type does not hold the value as it is."""
    kind = field.dataType
    if given == kind:
        return value
    text = value.cast("string")
    if isinstance(kind, T.IntegralType):
        # A whole number may be written as 3.0.
        number = text.try_cast("decimal(38,10)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    if isinstance(kind, T.DecimalType):
        exact = text.try_cast(kind)
        wide = text.try_cast(T.DecimalType(38, 38 - kind.precision + kind.scale))
        return F.when(wide == exact, exact)
    return text.try_cast(kind)


def _checked(field: T.StructField, given: T.StructType, invalid: str) -> Column:
    return _checked_value(field, F.col(field.name), given[field.name].dataType, invalid)


def _checked_value(field: T.StructField, value: Column, given: T.DataType, invalid: str) -> Column:
    cast = _cast_value(field, value, given)
    if invalid == "null" or given == field.dataType:
        return cast
    return F.when(value.isNull() | cast.isNotNull(), cast).otherwise(
        F.raise_error(_complaint(field, value)).cast(field.dataType)
    )


def _complaint(field: T.StructField, value: Column) -> Column:
    return F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), value.cast("string"))
