"""The declared shape of a table: ordered columns, types, keys, lengths."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Column as SparkColumn
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the audit columns and the prefix that marks them.
AUDIT_PREFIX = "AUD_"
CREATED = "AUD_CreateDatetime"
MODIFIED = "AUD_LastModDatetime"
DELETED = "AUD_isDeleted"
AUDIT_COLUMNS = (CREATED, MODIFIED, DELETED)

# Declared database type -> Spark type. The decimal family is
# resolved per column because precision and scale come from the contract.
SPARK_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "tinyint": T.ShortType(),
    "bit": T.IntegerType(),
    "money": T.DecimalType(19, 4),
    "smallmoney": T.DecimalType(10, 4),
    "float": T.DoubleType(),
    "real": T.DoubleType(),
    "char": T.StringType(),
    "varchar": T.StringType(),
    "nchar": T.StringType(),
    "nvarchar": T.StringType(),
    "text": T.StringType(),
    "ntext": T.StringType(),
    "uniqueidentifier": T.StringType(),
    "date": T.TimestampNTZType(),
    "datetime": T.TimestampNTZType(),
    "datetime2": T.TimestampNTZType(),
    "smalldatetime": T.TimestampNTZType(),
    "datetimeoffset": T.TimestampType(),
    "time": T.StringType(),
    "xml": T.StringType(),
    "sysname": T.StringType(),
    "timestamp": T.BinaryType(),
    "rowversion": T.BinaryType(),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "image": T.BinaryType(),
}
# A time of day is carried as text of one form, which sorts as times do.
TIME_FORMAT = "HH:mm:ss.SSSSSS"

# Ranges narrower than the Spark type that carries them.
VALUE_RANGES = {"tinyint": (0, 255), "bit": (0, 1)}
ROWVERSION_BYTES = 8


def is_audit(name: str) -> bool:
    """Literal prefix test; the underscore is not a wildcard, so AUDIT is not an audit column."""
    return name.startswith(AUDIT_PREFIX)


@dataclass(frozen=True)
class Column:
    name: str
    type_name: str
    length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    key: bool = False
    source: str | None = None

    def __post_init__(self) -> None:
        self.spark_type  # an unknown type or an invalid precision fails at declaration

    @property
    def source_name(self) -> str:
        return self.source or self.name

    @property
    def spark_type(self) -> T.DataType:
        if self.type_name in ("decimal", "numeric"):
            precision, scale = self.precision or 18, self.scale or 0
            if not 0 <= scale <= precision <= 38:
                raise ValueError(f"{self.name}: invalid decimal({precision},{scale})")
            return T.DecimalType(precision, scale)
        if self.type_name not in SPARK_TYPES:
            raise ValueError(f"{self.name}: unknown type {self.type_name!r}")
        return SPARK_TYPES[self.type_name]


@dataclass(frozen=True)
class Contract:
    """Columns in declared order. Audit columns may be listed but are never read from a source."""

    columns: tuple[Column, ...]

    def __init__(self, columns: Iterable[Column]):
        object.__setattr__(self, "columns", tuple(columns))
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError(f"repeated column in contract: {names}")

    @property
    def data_columns(self) -> tuple[Column, ...]:
        return tuple(c for c in self.columns if not is_audit(c.name))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.data_columns]

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.data_columns if c.key]

    @property
    def compare(self) -> list[str]:
        return [c.name for c in self.data_columns if not c.key]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def project(self, df: DataFrame) -> DataFrame:
        """Declared source columns only, in order, renamed to their target names."""
        return df.select(*[F.col(c.source_name).alias(c.name) for c in self.data_columns])

    def cast(self, df: DataFrame) -> DataFrame:
        """Convert every column strictly: a bad value fails the job."""
        return df.select(*[convert(F.col(c.name), c, df.schema[c.name].dataType).alias(c.name)
                           for c in self.data_columns])

    def target_schema(self) -> T.StructType:
        fields = [T.StructField(c.name, c.spark_type, c.nullable) for c in self.data_columns]
        fields += [
            T.StructField(CREATED, T.TimestampNTZType(), False),
            T.StructField(MODIFIED, T.TimestampNTZType(), False),
            T.StructField(DELETED, T.IntegerType(), False),
        ]
        return T.StructType(fields)


def convert(value: SparkColumn, column: Column, source_type: T.DataType, strict: bool = True) -> SparkColumn:
    """``value`` in the contract type; a failed conversion stops the job, or gives NULL if not ``strict``."""
    target = column.spark_type
    if column.type_name == "time":
        moment = value if isinstance(source_type, (T.TimestampType, T.TimestampNTZType)) else F.concat(F.lit("1970-01-01 "), value.cast("string")).try_cast("timestamp_ntz")
        converted = F.date_format(moment, TIME_FORMAT)
    elif source_type == target:
        return value
    elif isinstance(target, T.BinaryType):
        if isinstance(source_type, T.StringType):  # text such as 0x0000000000004652
            converted = F.try_to_binary(F.regexp_replace(value, "^0[xX]", ""), F.lit("hex"))
        else:
            converted = F.unhex(F.lpad(F.hex(value.cast("bigint")), 2 * ROWVERSION_BYTES, "0"))
    else:
        converted = value.try_cast(target)
    if not strict:
        return converted
    failure = F.raise_error(F.lit(f"{column.name}: a value cannot be converted to {target.simpleString()}"))
    return F.when(value.isNull() | converted.isNotNull(), converted).otherwise(failure.cast(target))
