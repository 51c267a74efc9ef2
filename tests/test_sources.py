"""Exports and stored tables."""

import tempfile

import pytest
from pyspark.sql import functions as F

from clientele.sources import exports, schemas, tables


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_quotes_blanks_and_bad_rows(spark, tmp_path):
    path = write(
        tmp_path / "no_call.csv",
        'id,reason\n1,"asked, twice"\n2,"said ""no"""\nthree,x\n4,\n5,""\n6,a,b\n',
    )
    export = exports.read_export(spark, path, schemas.NO_CALL)
    good = {r.id: r.reason for r in exports.good_rows(export).collect()}
    assert good == {1: "asked, twice", 2: 'said "no"', 4: None, 5: None}
    report = exports.load_report(export).first()
    assert (report.rows_read, report.bad_rows, report.low_key) == (6, 2, 1)
    assert exports.good_rows(export).select("id").count() == 4


def test_encoding_and_line_breaks(spark, tmp_path):
    path = write(tmp_path / "n.csv", 'id,reason\n1,"größe\nzwei"\n', "latin-1")
    export = exports.read_export(spark, path, schemas.NO_CALL, encoding="ISO-8859-1", multi_line=True)
    assert export.first().reason == "größe\nzwei"


def test_snapshots_replace_their_own_week_only(spark):
    path = tables.new_table_path(spark, "snap")
    first = spark.createDataFrame([(1,)], "id int")
    tables.save_snapshot(first, path, "w15_26")
    tables.save_snapshot(first, path, "w15_32")
    tables.save_snapshot(spark.createDataFrame([(2,)], "id int"), path, "w15_26")
    assert [r.id for r in tables.read_snapshot(spark, path, "w15_26").collect()] == [2]
    assert [r.id for r in tables.read_snapshot(spark, path, "w15_32").collect()] == [1]
    plan = tables.read_snapshot(spark, path, "w15_32")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(snapshot_week" in plan


def test_tables_live_in_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = tables.shared_dir(spark)
    assert folder == named.rstrip("/") if named else folder.startswith(tempfile.gettempdir())
    assert tables.new_table_path(spark, "t").startswith(f"{folder}/t-")


def test_no_temporary_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError):
        tables.shared_dir(Session())


def test_save_append_and_publish(spark, tmp_path):
    path = tables.new_table_path(spark, "t")
    df = spark.range(3)
    tables.save(df, path)
    assert tables.save(df, path, append=True).count() == 6
    assert tables.save(df, path).count() == 3
    out = str(tmp_path / "report")
    tables.publish(df.withColumn("pct", F.lit("5%")), out, {"id": "Week:", "pct": "% of calls"})
    assert spark.read.option("header", True).csv(out).columns == ["Week:", "% of calls"]


def test_every_layout_has_unique_names():
    layouts = [v for k, v in vars(schemas).items() if k.isupper()]
    layouts = [s for s in layouts if hasattr(s, "fieldNames")]
    assert len(layouts) > 20
    assert all(len(set(s.fieldNames())) == len(s.fieldNames()) for s in layouts)


def test_columns_are_found_by_header(spark, tmp_path):
    write(tmp_path / "a.csv", "id,reason\n1,asked\n")
    write(tmp_path / "b.csv", '\ufeffReason ,"Since, when",ID\nmoved,2015,2\n,2016,x\n')
    write(tmp_path / "c.csv", "No,Reason,Reason\n3,r,s\n")
    write(tmp_path / "d.csv", "")
    export = exports.read_by_header(spark, str(tmp_path), schemas.NO_CALL, {"no": "id"})
    good = {r.id: r.reason for r in exports.good_rows(export).collect()}
    assert good == {1: "asked", 2: "moved", 3: "r"}
    assert export.columns == ["id", "reason", exports.UNKNOWN, exports.BAD_ROW]
    assert export.filter(F.col(exports.BAD_ROW).isNotNull()).count() == 1
    report = {r.column: (r.rows_read, r.filled) for r in exports.header_report(export).collect()}
    assert report == {"Since, when": (2, 2), "Reason": (1, 1)}


def test_no_files_by_header(spark, tmp_path):
    write(tmp_path / "empty.csv", "")
    assert exports.read_by_header(spark, str(tmp_path), schemas.NO_CALL).collect() == []


def test_a_failed_replacement_leaves_the_table(spark):
    path = tables.new_table_path(spark, "kept")
    tables.save(spark.range(10), path)
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.save(broken, path)
    assert spark.read.parquet(path).count() == 10
    # Replaced by rows read from itself; nothing else is left beside it.
    assert tables.save(spark.read.parquet(path).filter("id < 3"), path).count() == 3
    files, make = tables._files(spark, path)
    left = [s.getPath().getName() for s in files.listStatus(make(path).getParent())]
    assert [x for x in left if x.startswith(make(path).getName())] == [make(path).getName()]


def test_an_interrupted_replacement_is_put_back(spark):
    path = tables.new_table_path(spark, "lost")
    tables.save(spark.range(10), path)
    files, make = tables._files(spark, path)
    # What a driver leaves that is lost between the two renames.
    files.rename(make(path), make(f"{path}.old-1"))
    spark.range(3).write.parquet(f"{path}.new-1")
    assert tables.recover(spark, path) and spark.read.parquet(path).count() == 10
    assert not tables.recover(spark, path)
    assert not files.exists(make(f"{path}.new-1")) and not files.exists(make(f"{path}.old-1"))
