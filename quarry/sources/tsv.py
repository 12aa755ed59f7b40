"""Tab-separated text of the wire format: read and written by Spark, escapes by expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What follows a backslash, and the character it stands for.
ESCAPES = {"b": "\b", "f": "\f", "r": "\r", "n": "\n", "t": "\t", "0": "\0", "'": "'", "\\": "\\"}
NULL = r"\N"


def unescaped(field: Column) -> Column:
    r"""A field's value: \N is null, escapes are resolved from left to right; an unknown one stays as it is, backslash included."""
    def turned(pair: Column) -> Column:
        second = F.substring(pair, 2, 1)
        value = pair
        for letter, character in ESCAPES.items():
            value = F.when(second == letter, F.lit(character)).otherwise(value)
        return F.when(F.startswith(pair, F.lit("\\")) & (F.length(pair) == 2), value).otherwise(pair)

    parts = F.regexp_extract_all(field, F.lit(r"(?s)\\.|[^\\]+|\\\z"), F.lit(0))
    return F.when(field == NULL, F.lit(None)).when(~F.contains(field, F.lit("\\")), field).otherwise(F.array_join(F.transform(parts, turned), ""))


def escaped(value: Column) -> Column:
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for letter, character in ESCAPES.items():
        if character != "\\":
            out = F.replace(out, F.lit(character), F.lit("\\" + letter))
    return F.coalesce(out, F.lit(NULL))


def array_text(field: Column, element: T.DataType) -> Column:
    """An array's text, `[1,2]` or `['a','b',NULL]`, as an array; strings are quoted, with escapes as in fields."""
    if not isinstance(element, T.StringType):
        return F.from_json(F.regexp_replace(field, r"\bNULL\b", "null"), T.ArrayType(element))
    items = F.regexp_extract_all(field, F.lit(r"(?s)'(?:[^'\\]|\\.)*'|NULL"), F.lit(0))
    return F.when(field.isNotNull(), F.transform(items, lambda x: F.when(x != "NULL", unescaped(F.substring(x, F.lit(2), F.length(x) - 2)))))


def _typed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType):
        return array_text(value, kind.elementType)
    if isinstance(kind, T.BooleanType):
        return value.isin("1", "true")
    if isinstance(kind, T.VariantType):
        return F.parse_json(value)
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        value = F.when(~value.startswith("0000-00-00"), value)
    return value.cast(kind)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lines of the files under path as rows of the schema. Missing fields are null; an empty field is an empty string."""
    fields = F.split("value", "\t", -1)
    lines = spark.read.text(path, lineSep="\n").select(fields.alias("f"))
    field = lambda i, kind: F.nullif(F.get("f", F.lit(i)), F.lit(NULL)) if isinstance(kind, T.ArrayType) else unescaped(F.get("f", F.lit(i)))
    return lines.select(*[_typed(field(i, c.dataType), c.dataType).alias(c.name) for i, c in enumerate(schema)])


def lines(df: DataFrame) -> DataFrame:
    """One column, value: each row as a line."""
    def text(c: T.StructField) -> Column:
        col = F.col(f"`{c.name}`")
        if isinstance(c.dataType, T.BooleanType):
            return escaped(col.cast("int").cast("string"))
        if isinstance(c.dataType, T.ArrayType) and isinstance(c.dataType.elementType, T.StringType):
            quoted = F.transform(col, lambda x: F.when(x.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit("'"), escaped(x), F.lit("'"))))
            return F.coalesce(F.concat(F.lit("["), F.array_join(quoted, ","), F.lit("]")), F.lit(NULL))
        return escaped(plain(c, col))

    def plain(c: T.StructField, col: Column) -> Column:
        if isinstance(c.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return F.to_json(col)
        return col.cast("string")

    return df.select(F.concat_ws("\t", *[text(c) for c in df.schema]).alias("value"))


def write(df: DataFrame, path: str, mode: str = "error") -> None:
    lines(df).write.mode(mode).text(path)
