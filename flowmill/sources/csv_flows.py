"""Reading a folder of flow CSV files as one table."""

from __future__ import annotations

import csv
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmill.functions.columns import NUMBER_PATTERN, find_target, q
from flowmill.sources import files

UTF8, LATIN1 = "UTF-8", "ISO-8859-1"
ODD_ROW = "row of another length"

# Cell texts that mean "missing" in the CSV dialect this reader follows.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def find_csv_files(spark: SparkSession, folder: str) -> list[str]:
    found = files.glob(spark, f"{folder.rstrip('/')}/*.csv")
    if not found:
        raise FileNotFoundError(f"no CSV files in {folder}: put the raw flow files there")
    return found


def header_names(line: str | None) -> list[str]:
    """Column names of a header line: repeated names get .1, .2, ...; then blanks are trimmed."""
    cells = next(csv.reader([(line or "").lstrip("\ufeff")]), [])
    used: set[str] = set()
    names = []
    for i, cell in enumerate(cells):
        base = cell if cell else f"Unnamed: {i}"
        name, n = base, 0
        while name in used:
            n += 1
            name = f"{base}.{n}"
        used.add(name)
        names.append(name)
    trimmed = [n.strip() for n in names]
    if len(set(trimmed)) < len(trimmed):
        raise ValueError(f"column names differ only in blanks: {sorted(n for n in set(trimmed) if trimmed.count(n) > 1)}")
    return trimmed


@dataclass(frozen=True)
class CsvFile:
    """What has to be known of a file before it is read."""

    path: str
    encoding: str
    names: tuple[str, ...]
    multiline: bool  # a quoted cell runs over the end of a line


def look_at(spark: SparkSession, paths: list[str], encoding: str | None = None) -> list[CsvFile]:
    """Header, encoding and quoted line breaks of every file, from one byte-level pass over their lines.

    A file is read as ``encoding``, or, if none is given, as Latin-1 when a line is no valid UTF-8.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
        F.is_valid_utf8("value").alias("utf8"),
        F.col("value").cast("binary").alias("raw"),
        ((F.octet_length("value") - F.octet_length(F.replace("value", F.lit(chr(34)), F.lit("")))) % 2 == 1).alias("open_quote"),
    )
    facts = lines.groupBy("path").agg(
        F.min_by("raw", "place").alias("header"), F.min("utf8").alias("utf8"), F.max("open_quote").alias("multiline")
    )
    found = {_local_name(r["path"]): r for r in facts.collect()}  # one row per file
    seen = []
    for path in paths:
        r = found.get(_local_name(path))  # none for an empty file
        kind = encoding or (UTF8 if r is None or r["utf8"] else LATIN1)
        names = header_names(bytes(r["header"]).decode(kind, "replace").rstrip("\r") if r else None)
        seen.append(CsvFile(path, kind, tuple(names), bool(r and r["multiline"])))
    return seen


def _local_name(path: str) -> str:
    """Paths compared without their scheme and escapes, which listings and metadata write differently."""
    return "/" + unquote(path.split(":", 1)[-1]).lstrip("/")


def read_text_columns(spark: SparkSession, folder: str, encoding: str | None = None) -> DataFrame:
    """All files of the folder as string columns; an empty or missing-value cell is null.

    Files must share one set of columns; their order may differ. Cells may be quoted, with quotes doubled inside and
    with line breaks. A row with fewer cells than the header ends in nulls; one with more is an error when it is read.
    """
    seen = look_at(spark, find_csv_files(spark, folder), encoding)
    expected = seen[0].names
    groups: dict[tuple, list[str]] = {}
    for f in seen:
        if set(f.names) != set(expected):
            missing, extra = sorted(set(expected) - set(f.names)), sorted(set(f.names) - set(expected))
            raise ValueError(f"{f.path} has other columns than the first file. Missing: {missing}. Extra: {extra}")
        groups.setdefault((f.encoding, f.names, f.multiline), []).append(f.path)
    table = None
    for (kind, names, multiline), members in groups.items():
        cells = [f"c{i}" for i in range(len(names))]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cells, ODD_ROW]])
        part = (
            spark.read.schema(schema)
            .options(header=True, enforceSchema=True, encoding=kind, multiLine=multiline, quote='"', escape='"')
            # without pruning the parser sees all cells of a row, however few columns a query needs
            .options(columnNameOfCorruptRecord=ODD_ROW, columnPruning=False, maxCharsPerColumn=-1)
            .csv(members)
        )
        part = part.where(_no_more_cells(len(names)))
        part = part.select(*[F.when(~F.col(c).isin(*MISSING_TOKENS), F.col(c)).alias(n) for c, n in zip(cells, names)])
        table = part if table is None else table.unionByName(part)
    return table


def _no_more_cells(n: int) -> Column:
    """True for rows of at most ``n`` cells, an error for others. The parser keeps rows of another number as text."""
    bare = F.regexp_replace(ODD_ROW, '"(?:[^"]|"")*"', "")
    commas = F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(","), F.lit("")))
    # the first cell is named so that the parser is asked for a column of the file
    told = F.concat(F.lit(f"a row has more than the header's {n} cells, in "), F.col("_metadata.file_path"))
    wrong = F.raise_error(F.concat(told, F.lit(", first cell: "), F.coalesce("c0", F.lit("")))).cast("boolean")
    return F.when(F.col(ODD_ROW).isNull() | (commas < n), F.lit(True)).otherwise(wrong)


def with_types(df: DataFrame, target: str = "Label") -> DataFrame:
    """String columns whose every value is a number become doubles; one scan decides for all."""
    label = find_target(df.columns, target)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != label]
    if not texts:
        return df
    row = df.agg(*[F.count_if(~q(c).rlike(NUMBER_PATTERN)).alias(f"bad{i}") for i, c in enumerate(texts)]).first()
    numbers = {c for i, c in enumerate(texts) if not row[f"bad{i}"]}
    return df.select(*[q(c).try_cast("double").alias(c) if c in numbers else q(c) for c in df.columns])


def load_flows(
    spark: SparkSession,
    folder: str,
    target: str = "Label",
    numeric: list[str] | None = None,
    encoding: str | None = None,
) -> DataFrame:
    """The raw flow table of a folder. ``numeric`` names the number columns and saves the typing scan."""
    df = read_text_columns(spark, folder, encoding)
    if numeric is None:
        return with_types(df, target)
    wanted = set(numeric)
    return df.select(*[q(c).try_cast("double").alias(c) if c in wanted else q(c) for c in df.columns])
