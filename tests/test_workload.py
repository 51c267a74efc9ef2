"""Every query against the SQL that states its result, on the smallest data set."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as app
from workload.inputs import TABLES, Inputs
from workload.registry import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", app.SMOKE_DIR)
KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def comparable(rows):
    def plain(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    def order(row):
        return tuple((v is None, v if v is not None else 0) for v in row)

    return sorted((tuple(plain(v) for v in r) for r in rows), key=order)


@pytest.mark.parametrize("name", sorted(app.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = app.queries()[name](spark, FOLDER)
    kinds = dict(df.dtypes)
    result = duck.execute(app.oracle_sql()[name])
    expected_kinds = {c[0]: str(c[1]) for c in result.description}
    assert {c: KINDS[k] for c, k in kinds.items()} == expected_kinds
    names = sorted(kinds)
    at = [list(expected_kinds).index(c) for c in names]
    expected = comparable(tuple(r[i] for i in at) for r in result.fetchall())
    assert comparable(tuple(r) for r in df.select(*names).collect()) == expected
    assert expected or FOLDER == app.SMOKE_DIR


def test_random_numbers_have_five_digits(spark):
    drawn = [r.in_range for r in app.queries()["q_blast_list_random"](spark, FOLDER).select("in_range").collect()]
    assert drawn and all(drawn)


@pytest.mark.parametrize("name", ["q_sms_list", "q_route_leads", "q_scorecard_sent", "q_responses", "q_value_curve"])
def test_plans_start_no_job(spark, name):
    inputs = Inputs(spark, FOLDER)
    for table in TABLES:
        getattr(inputs, table)  # reading a schema takes a job
    spark.sparkContext.setJobGroup(f"plan {name}", "building a plan")
    try:
        QUERIES[name].plan(inputs)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"plan {name}")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_entry_has_rows(spark):
    assert app.entry(spark).count() > 0


def test_exports_are_written_by_all_cores(spark, tmp_path, monkeypatch):
    """A table of one file and one row group is one task, unless it is dealt again."""
    from clientele.sources import exports, schemas

    monkeypatch.setattr(schemas, "LAYOUTS", {"members": schemas.MEMBERS})
    customers = spark.range(40_000).selectExpr("id AS c_custkey", "'BUILDING' AS c_mktsegment")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    written = []
    write = exports.write_export
    monkeypatch.setattr(exports, "write_export", lambda df, *a, **k: (written.append(df), write(df, *a, **k)))
    found = app.queries()["q_export_layouts"](spark, str(tmp_path)).first()
    assert (found.layout, found.rows_read, found.bad_rows) == ("members", 40_000, 0)
    assert len(written) == 2
    for df in written:
        rows = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert len(rows) == 8 and max(rows) < 2 * min(rows)
