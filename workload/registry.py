"""Queries by name, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, ShortType

from clientele.session import tune
from workload.inputs import Inputs, with_inputs


@dataclass(frozen=True)
class Query:
    plan: Callable[[Inputs], DataFrame]
    sql: str

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(self.plan(Inputs(tune(spark), folder)))


QUERIES: dict[str, Query] = {}


def functions() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query as a plain function of session and data folder."""

    def of(name: str, q: Query) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return q(spark, folder)

        run.__name__ = name
        return run

    return {name: of(name, q) for name, q in QUERIES.items()}


def query(sql: str) -> Callable:
    """Register a plan over ``Inputs`` under its function name."""

    def keep(plan: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[plan.__name__] = Query(plan, with_inputs(sql))
        return plan

    return keep


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles and small integers as longs, as the comparison expects them."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (ByteType, ShortType, IntegerType)):
            c = c.cast("long")
        out.append(c.alias(field.name))
    return df.select(*out)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round sums of doubles, whose last digits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- pieces of comparison SQL ---------------------------------------------------------


def nb(column: str) -> str:
    """The column when it holds text."""
    return f"(CASE WHEN trim(coalesce({column}, '')) <> '' THEN {column} END)"


def blank(column: str) -> str:
    return f"(trim(coalesce({column}, '')) = '')"


def slash_date(column: str) -> str:
    return f"CAST(try_strptime(split_part(trim({column}), ' ', 1), '%m/%d/%Y') AS DATE)"


def cash(column: str) -> str:
    """Money text as a decimal."""
    return (
        f"(CASE WHEN {blank(column)} THEN CAST(0 AS DECIMAL(10,2)) ELSE "
        f"TRY_CAST(trim(replace(replace({column}, '$', ''), ',', '')) AS DECIMAL(10,2)) END)"
    )


def week(column: str) -> str:
    """W98.07 of a date."""
    return f"('W' || right(CAST(isoyear({column}) AS VARCHAR), 2) || '.' || lpad(CAST(weekofyear({column}) AS VARCHAR), 2, '0'))"


def clock(seconds: str) -> str:
    s = f"CAST({seconds} AS BIGINT)"
    return (
        f"(CASE WHEN {s} < 36000 THEN '0' ELSE '' END || CAST({s} // 3600 AS VARCHAR) || ':' || lpad(CAST({s} % 3600 // 60 AS VARCHAR), 2, '0')"
        f" || ':' || lpad(CAST({s} % 60 AS VARCHAR), 2, '0'))"
    )


def percent(share: str) -> str:
    return f"(CAST(CAST(round(({share}) * 100, 2) AS DECIMAL(14,2)) AS VARCHAR) || '%')"


def domestic(column: str) -> str:
    return f"(coalesce(lower(trim({column})), '') IN ('united states', 'canada', 'usa', 'us'))"


def group_of(column: str) -> str:
    return f"(CASE WHEN {domestic(column)} THEN 'Domestic' ELSE 'International' END)"


def any_area(phone: str) -> str:
    return f"left(regexp_replace(regexp_replace({phone}, '[^0-9]', '', 'g'), '^1', ''), 3)"


def area_or_place(phone: str, country: str, place: str) -> str:
    return f"(CASE WHEN {domestic(country)} AND NOT {blank(phone)} THEN {any_area(phone)} ELSE {place} END)"
