"""Delimited exports: read into a fixed layout, keep what could not be read visible."""

from __future__ import annotations

import csv
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from clientele.functions.text import not_blank

BAD_ROW = "_bad"


def read_export(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Read comma-separated files with a header line and optional double quotes.

    Rows that do not fit the layout keep their text in ``_bad``.  Leave ``multi_line``
    off unless quoted fields hold line breaks: it stops Spark from splitting files.  All
    columns are parsed whatever a query selects, so that a row is bad for every query or none.
    """
    full = StructType([*schema.fields, StructField(BAD_ROW, StringType())])
    rows = (
        spark.read.schema(full)
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .csv(path)
    )
    # Spark looks at a value only where its column is asked for, and refuses to read the bad-row
    # column alone, as counting rows would.  This ties it to the first column and to all that are
    # not text, without changing it.
    tied = [schema.fields[0], *(f for f in schema.fields[1:] if not isinstance(f.dataType, StringType))]
    looked_at = F.concat_ws("", *(F.col(f.name).cast("string") for f in tied))
    return rows.withColumn(BAD_ROW, F.when(looked_at != F.lit("\0"), F.col(BAD_ROW)))


UNKNOWN = "_unknown"


def plain_name(header: str) -> str:
    """A column's name as layouts write it: small letters, one underscore for blanks and the like."""
    return re.sub(r"[^0-9a-z]+", "_", header.strip().lstrip("\ufeff").lower()).strip("_")


def headers(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> dict[tuple[str, ...], list[str]]:
    """The files of an export by their header line; reads the first line of each file only."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = where.getFileSystem(conf).open(where)
        try:
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding)).readLine()
        finally:
            stream.close()
        if line is not None:
            found.setdefault(tuple(next(csv.reader([line]), ())), []).append(file)
    return found


def read_by_header(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    aliases: dict[str, str] | None = None,
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Read files whose columns are found by their header names, in any order.

    ``aliases`` maps names of other versions of the export to the layout's.  Files of different
    versions may lie side by side.  Columns a file lacks are NULL; those the layout does not know
    are kept as text in the map ``_unknown``, so that they are as visible as bad rows are in ``_bad``.
    A name that comes twice counts where it comes first.
    """
    known = {f.name: f for f in schema.fields}
    parts = []
    for header, files in headers(spark, path, encoding).items():
        fields, unknown = [], {}
        taken: set[str] = set()
        for k, title in enumerate(header):
            name = plain_name(title)
            name = (aliases or {}).get(name, name)
            if name in known and name not in taken:
                taken.add(name)
                fields.append(known[name])
            else:
                unknown[title or f"column {k + 1}"] = f"_other_{k}"
                fields.append(StructField(f"_other_{k}", StringType()))
        rows = read_export(spark, files, StructType(fields), encoding, multi_line)
        others = [x for title, c in unknown.items() for x in (F.lit(title), F.col(c))]
        extra = F.create_map(*others) if others else F.create_map().cast("map<string,string>")
        parts.append(
            rows.select(
                *(F.col(f.name) if f.name in taken else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields),
                extra.alias(UNKNOWN),
                BAD_ROW,
            )
        )
    if not parts:
        full = StructType([*schema.fields, StructField(UNKNOWN, MapType(StringType(), StringType())), StructField(BAD_ROW, StringType())])
        return spark.createDataFrame([], full)
    return reduce(DataFrame.unionByName, parts)


def header_report(export: DataFrame) -> DataFrame:
    """Columns the layout does not know, with how many rows have text in them."""
    named = export.select(F.explode(UNKNOWN).alias("column", "value"))
    return named.groupBy("column").agg(F.count("*").alias("rows_read"), F.count_if(not_blank("value")).alias("filled"))


def write_export(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8") -> None:
    """Write comma-separated files with a header line."""
    quoted = df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
    quoted.option("encoding", encoding).csv(path)


def load_report(export: DataFrame) -> DataFrame:
    """Rows read, rows that did not fit the layout, and the range of the first column."""
    key = export.columns[0]
    return export.agg(
        F.count("*").alias("rows_read"),
        F.count(BAD_ROW).alias("bad_rows"),
        F.min(key).alias("low_key"),
        F.max(key).alias("high_key"),
    )


def good_rows(export: DataFrame) -> DataFrame:
    """The rows that fit, without the ``_bad`` and ``_unknown`` columns."""
    return export.filter(F.col(BAD_ROW).isNull()).drop(BAD_ROW, UNKNOWN)
