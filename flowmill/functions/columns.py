"""Column expressions shared by every operator. All of them stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\r\f\x0b"

# Name parts that mark a column as an identifier, matched in lower case.
IDENTIFIER_HINTS = (
    "flow id",
    "src ip",
    "source ip",
    "dst ip",
    "destination ip",
    "timestamp",
)

# Text that counts as a number: what Java's parser adds ("1d", "0x1p3") does not.
NUMBER_PATTERN = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def q(name: str) -> Column:
    """A column by its exact name; flow columns hold dots, slashes and spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the numeric columns in table order."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


_IDENTIFIER = re.compile("|".join(map(re.escape, IDENTIFIER_HINTS)), re.IGNORECASE)


def identifier_columns(columns: Sequence[str]) -> list[str]:
    """Columns whose name marks them as an identifier, in any case."""
    return list(filter(_IDENTIFIER.search, columns))


def find_target(columns: Sequence[str], configured: str = "Label") -> str:
    """The label column. Several spellings may fit but for case and blanks: the given one wins, then the last."""

    def bare(name: str) -> str:
        return name.strip().casefold()

    spellings = [c for c in columns if bare(c) == bare(configured)]
    if not spellings:
        raise ValueError(f"none of the {len(columns)} columns is the label {configured!r}: {', '.join(columns)}")
    return max(spellings, key=lambda c: (c == configured, spellings.index(c)))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def fold(c: Column) -> Column:
    return F.lower(strip(c))


def finite(c: Column) -> Column:
    """The value as a double, null when it is NaN or infinite (NaN sorts above infinity)."""
    value = c.cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def is_missing(df: DataFrame, name: str) -> Column:
    c = q(name)
    return c.isNull() | F.isnan(c) if is_floating(df.schema[name].dataType) else c.isNull()


def is_infinite(c: Column) -> Column:
    return F.abs(c) == F.lit(float("inf"))


def to_number(c: Column, dtype: T.DataType) -> Column:
    """The value as a double; text that is no number becomes null."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def without_nan(df: DataFrame) -> DataFrame:
    """NaN turned into null, so that both count as the same missing value in groupings."""
    return df.select(
        *[
            F.nanvl(q(f.name), F.lit(None).cast(f.dataType)).alias(f.name) if is_floating(f.dataType) else q(f.name)
            for f in df.schema.fields
        ]
    )


def order_hash(key: Column | Sequence[Column], seed: int) -> Column:
    """A seeded order key that does not depend on partitioning (32 hex digits)."""
    if isinstance(key, Column):
        text = key.cast("string")
    else:
        text = F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in key])
    return F.md5(F.concat(text, F.lit(f"|{seed}")))


def is_attack(predicted: Column, benign: str = "BENIGN") -> Column:
    return F.lower(predicted) != F.lit(benign.lower())


def choose(value: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """A value-to-literal lookup without a join: one flat CASE, whatever the number of keys. Null finds the default."""
    cases: Column | None = None
    for known, out in mapping.items():
        hit = value == F.lit(known)
        cases = F.when(hit, F.lit(out)) if cases is None else cases.when(hit, F.lit(out))
    if cases is None:
        return F.lit(None) if default is None else default
    return cases if default is None else cases.otherwise(default)


def small_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """A driver-held table as a JVM local relation (no Python round trip in the plan)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrays = [pa.array(list(values), type=field.type) for values, field in zip(columns, to_arrow_schema(schema))]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=[f.name for f in schema.fields]), schema=schema)
