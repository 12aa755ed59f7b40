"""The column types of the remote dialect, parsed into Spark types."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

#: Names of types without arguments.
SIMPLE: dict[str, T.DataType] = {
    "Bool": T.BooleanType(),
    "Int8": T.ShortType(), "UInt8": T.ShortType(), "Int16": T.ShortType(), "UInt16": T.IntegerType(), "Int32": T.IntegerType(), "UInt32": T.LongType(), "Int64": T.LongType(),
    "UInt64": T.DecimalType(20, 0), "Int128": T.DecimalType(38, 0), "UInt128": T.DecimalType(38, 0), "Float32": T.FloatType(), "Float64": T.DoubleType(),
    "String": T.StringType(), "UUID": T.StringType(), "IPv4": T.StringType(), "IPv6": T.StringType(), "JSON": T.VariantType(),
    "Date": T.DateType(), "Date32": T.DateType(), "DateTime": T.TimestampNTZType(), "Nothing": T.NullType(),
}
_DIGITS = {"Decimal32": 9, "Decimal64": 18, "Decimal128": 38}
_TOKEN = re.compile(r"\s*(?:([A-Za-z_][A-Za-z0-9_.]*)|(-?\d+)|'((?:[^'\\]|\\.|'')*)'|`([^`]*)`|([(),=]))")


class TypeSyntaxError(ValueError):
    """The text is not a type of the dialect."""


@dataclass(frozen=True)
class Remote:
    """A parsed type: Spark's, whether it may be null, and what else a column must remember."""

    spark: T.DataType
    nullable: bool = False
    metadata: dict = field(default_factory=dict)


class _Reader:
    def __init__(self, text: str) -> None:
        self.text, self.at = text, 0

    def fail(self, why: str) -> TypeSyntaxError:
        return TypeSyntaxError(f"{why} at {self.at} of {self.text!r}")

    def peek(self) -> tuple[str, str] | None:
        m = _TOKEN.match(self.text, self.at)
        if not m:
            if self.text[self.at :].strip():
                raise self.fail("unexpected character")
            return None
        kind = ("name", "number", "string", "name", "mark")[next(i for i in range(5) if m[i + 1] is not None)]
        return kind, next(m[i] for i in range(1, 6) if m[i] is not None)

    def take(self, want: str | None = None) -> str:
        found = self.peek()
        if found is None or want and found[1] != want and found[0] != want:
            raise self.fail(f"expected {want or 'more'}")
        self.at = _TOKEN.match(self.text, self.at).end()
        return found[1]

    def is_next(self, mark: str) -> bool:
        found = self.peek()
        return found is not None and found == ("mark", mark)

    def listed(self, item) -> list:
        self.take("(")
        out = []
        while not self.is_next(")"):
            out.append(item())
            if not self.is_next(")"):
                self.take(",")
        self.take(")")
        return out

    def literal(self) -> str:
        kind, value = self.peek() or ("", "")
        if kind not in ("number", "string"):
            raise self.fail("expected a number or a string")
        return self.take()

    def pair(self) -> str:
        label = self.take("string")
        self.take("=")
        self.take("number")
        return label

    def member(self) -> tuple[str | None, Remote]:
        """An element of a tuple, with or without a name before its type."""
        kept, name = self.at, self.take("name")
        after = self.peek()
        if after and after[0] == "name":
            return name, self.type()
        self.at = kept
        return None, self.type()

    def type(self) -> Remote:
        name = self.take("name")
        if name == "Nullable":
            (inner,) = self.listed(self.type) or [None]
            if inner.nullable:
                raise self.fail("Nullable within Nullable")
            return Remote(inner.spark, True, inner.metadata)
        if name == "LowCardinality":
            (inner,) = self.listed(self.type)
            return inner
        if name == "Array":
            (inner,) = self.listed(self.type)
            return Remote(T.ArrayType(inner.spark, inner.nullable), False, inner.metadata and {"element": inner.metadata})
        if name == "Map":
            key, value = self.listed(self.type)
            return Remote(T.MapType(key.spark, value.spark, value.nullable))
        if name in ("Tuple", "Nested"):
            parts = [(n or f"_{i}", r) for i, (n, r) in enumerate(self.listed(self.member), 1)]
            struct = T.StructType([T.StructField(n, r.spark, r.nullable) for n, r in parts])
            return Remote(T.ArrayType(struct, False) if name == "Nested" else struct)
        if name in ("Enum8", "Enum16"):
            return Remote(T.StringType(), False, {"enum": self.listed(self.pair)})
        if name == "FixedString":
            (n,) = self.listed(self.literal)
            return Remote(T.StringType(), False, {"fixed": int(n)})
        if name == "DateTime64":
            args = self.listed(self.literal)
            return Remote(T.TimestampNTZType(), False, {"precision": int(args[0])} | ({"zone": args[1]} if len(args) > 1 else {}))
        if name == "DateTime" and self.is_next("("):
            (zone,) = self.listed(self.literal)
            return Remote(T.TimestampNTZType(), False, {"zone": zone})
        if name == "Decimal":
            args = self.listed(self.literal)
            if len(args) != 2:
                raise self.fail("Decimal needs precision and scale")
            return Remote(T.DecimalType(int(args[0]), int(args[1])))
        if name in _DIGITS:
            (scale,) = self.listed(self.literal)
            return Remote(T.DecimalType(_DIGITS[name], int(scale)))
        if name in ("AggregateFunction", "SimpleAggregateFunction"):
            return self.state(name)
        if name in SIMPLE:
            return Remote(SIMPLE[name])
        raise self.fail(f"unknown type {name}")

    def state(self, name: str) -> Remote:
        self.take("(")
        function = self.take("name")
        parameters = self.listed(self.literal) if self.is_next("(") else []
        args = []
        while self.is_next(","):
            self.take(",")
            args.append(self.type())
        self.take(")")
        about = {"agg_state" if name[0] == "A" else "simple_agg": function} | ({"agg_parameters": parameters} if parameters else {})
        if function.startswith("count"):
            return Remote(T.LongType(), False, about)
        if function == "sumMap" and len(args) == 2:
            return Remote(T.MapType(args[0].spark.elementType, args[1].spark.elementType), False, about)
        if not args:
            raise self.fail(f"{function} needs the type of its argument")
        return Remote(args[0].spark, args[0].nullable, about)


def parse_type(text: str) -> Remote:
    """The type that a text of the dialect names; TypeSyntaxError if none."""
    reader = _Reader(text)
    found = reader.type()
    if reader.peek() is not None:
        raise reader.fail("unexpected rest")
    return found


def schema_of(columns: list[tuple[str, str]]) -> T.StructType:
    """A schema from names and type texts; columns are not null unless the type says so."""
    parsed = [(n, parse_type(x)) for n, x in columns]
    return T.StructType([T.StructField(n, r.spark, r.nullable, r.metadata) for n, r in parsed])
