"""Type names and type categories.

Spark types are mapped to the SQL type names a schema description shows, and
each name falls into one category by the upper-cased text before ``(``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: type-name groups and labels that must match the reference ---
NUMBER_TYPES = ["TINYINT", "SMALLINT", "MEDIUMINT", "INT", "INTEGER", "BIGINT", "FLOAT", "DOUBLE",
                "DECIMAL", "NUMERIC", "REAL", "DOUBLE PRECISION", "SMALLSERIAL", "SERIAL",
                "BIGSERIAL"]
STRING_TYPES = ["BLOB", "TINYBLOB", "MEDIUMBLOB", "LONGBLOB", "CHAR", "VARCHAR", "TEXT", "TINYTEXT",
                "MEDIUMTEXT", "LONGTEXT", "CHARACTER VARYING", "CHARACTER"]
DATE_TYPES = ["DATE", "TIME", "DATETIME", "TIMESTAMP", "TIMESTAMP WITHOUT TIME ZONE",
              "TIMESTAMP WITH TIME ZONE"]
BOOL_TYPES = ["BOOL", "BOOLEAN"]
TYPE_LABELS = ["Number", "String", "DateTime", "Bool", "Other"]
FIELD_CATEGORIES = ["Code", "Enum", "DateTime", "Text", "Measure"]
ROLES = ["Dimension", "Measure"]
DATE_GRANULARITIES = ["YEAR", "MONTH", "DAY", "QUARTER", "WEEK", "HOUR", "MINUTE", "SECOND",
                      "MILLISECOND", "MICROSECOND", "OTHER"]
DIALECTS = ["sqlite", "mysql", "postgresql", "mssql"]
# --- end of fixed values ---

# the short type names M-Schema lines show for date-like fields
SHORT_DATE_TYPES = ["DATE", "TIME", "DATETIME", "TIMESTAMP"]


def sql_type_name(dt: T.DataType) -> str:
    """Name our catalog emits for a Spark type (never Spark's ``STRING``)."""
    if isinstance(dt, T.ByteType):
        return "TINYINT"
    if isinstance(dt, T.ShortType):
        return "SMALLINT"
    if isinstance(dt, T.IntegerType):
        return "INTEGER"
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, T.FloatType):
        return "FLOAT"
    if isinstance(dt, T.DoubleType):
        return "DOUBLE"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, (T.StringType, T.CharType, T.VarcharType)):
        return "TEXT"
    if isinstance(dt, T.BinaryType):
        return "BLOB"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, T.ArrayType):
        return "ARRAY"
    if isinstance(dt, T.MapType):
        return "MAP"
    if isinstance(dt, T.StructType):
        return "STRUCT"
    return dt.simpleString().upper()


def type_abbr(name: str) -> str:
    return name.split("(")[0]


def type_category(name: str) -> str:
    """Driver-side twin of :func:`type_category_col` for schema-sized inputs."""
    t = type_abbr(name.upper())
    if t in NUMBER_TYPES:
        return "Number"
    if t in STRING_TYPES:
        return "String"
    if t in DATE_TYPES:
        return "DateTime"
    if t in BOOL_TYPES:
        return "Bool"
    return "Other"


def type_abbr_col(c: Column) -> Column:
    return F.substring_index(c, "(", 1)


def type_category_col(c: Column) -> Column:
    t = F.upper(type_abbr_col(c))
    return (F.when(t.isin(NUMBER_TYPES), F.lit("Number"))
            .when(t.isin(STRING_TYPES), F.lit("String"))
            .when(t.isin(DATE_TYPES), F.lit("DateTime"))
            .when(t.isin(BOOL_TYPES), F.lit("Bool"))
            .otherwise(F.lit("Other")))


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)
