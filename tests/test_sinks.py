"""Staging, load modes, constraints, snapshots and table definitions."""

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from cambio.operators.constraints import enforce, violations
from cambio.operators.latest import latest_price, latest_prices
from cambio.schemas import QUOTES_TABLE, STG_BROKERS, STG_COINS, STG_QUOTES, TABLES, broker_dimension
from cambio.plans.daily import Warehouse, merge_staged_quotes
from cambio.sinks.catalog import define_tables, describe_layout, load_table
from cambio.sinks.load import append_staging, load, replace_staging, truncate_staging
from cambio.sinks.snapshots import CommittedTable

T1 = datetime(2024, 1, 28, 5)
DAY = date(2024, 1, 1)


def staged(spark, *data):
    return spark.createDataFrame(list(data), STG_QUOTES.schema)


def quotes(spark, *data):
    return spark.createDataFrame(list(data), QUOTES_TABLE.schema)


def test_staging_holds_exactly_the_last_load(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    replace_staging(staged(spark, (1, 1, 1.0, None, T1), (1, 2, 1.0, None, T1)), STG_QUOTES, path)
    again = replace_staging(staged(spark, (2, 2, 3.0, 2.0, T1)), STG_QUOTES, path)
    assert rows(again) == [(2, 2, 3.0, 2.0, T1)]
    assert rows(append_staging(staged(spark, (2, 2, 3.0, 2.0, T1)), STG_QUOTES, path)) == [(2, 2, 3.0, 2.0, T1)] * 2
    empty = truncate_staging(spark, STG_QUOTES, path)
    assert empty.count() == 0 and empty.schema.fieldNames() == STG_QUOTES.columns
    assert replace_staging(staged(spark), STG_QUOTES, path).count() == 0


def test_a_failed_load_is_logged_and_raised(spark, tmp_path, caplog):
    with pytest.raises(PySparkException, match="lost"):
        load(spark.range(1).select(F.raise_error(F.lit("lost"))), str(tmp_path / "t"))
    assert "load into" in caplog.text and "failed" in caplog.text


def test_load_modes(spark, tmp_path):
    path, one = str(tmp_path / "t"), spark.range(1)
    load(one, path, "fail")
    with pytest.raises(AnalysisException):
        load(one, path, "fail")
    load(one, path)
    assert spark.read.parquet(path).count() == 2
    load(one, path, "replace")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(KeyError):
        load(one, path, "merge")


@pytest.mark.parametrize("bad", [(None, 1, 1.0, None, T1), (1, None, 1.0, None, T1), (1, 1, None, 1.0, T1)])
def test_null_fails_the_load(spark, tmp_path, bad):
    path = str(tmp_path / "s")
    replace_staging(staged(spark, (9, 9, 9.0, None, T1)), STG_QUOTES, path)
    with pytest.raises(PySparkException, match="must not be NULL"):
        replace_staging(staged(spark, (1, 2, 1.0, None, T1), bad), STG_QUOTES, path)


def test_name_limit_counts_bytes(spark):
    def name(text):
        return enforce(spark.createDataFrame([(1, text)], STG_COINS.schema), STG_COINS).collect()

    assert len(name("a" * 100)) == 1 and len(name(None)) == 1 and len(name("ñ" * 50)) == 1
    for long in ("a" * 101, "ñ" * 51):
        with pytest.raises(PySparkException, match="longer than 100 bytes"):
            name(long)


def test_violations_are_counted(spark, rows):
    frame = staged(spark, (1, 1, None, None, T1), (None, 1, None, None, T1), (1, 1, 1.0, None, None))
    assert rows(violations(frame, STG_QUOTES)) == [
        ("stg_cotizaciones", "broker_id is NULL", 0),
        ("stg_cotizaciones", "cripto_id is NULL", 1),
        ("stg_cotizaciones", "p_compra is NULL", 2),
    ]
    names = spark.createDataFrame([(1, "a" * 101), (2, None)], STG_BROKERS.schema)
    assert rows(violations(names, STG_BROKERS)) == [
        ("stg_brokers", "broker_id is NULL", 0),
        ("stg_brokers", "broker_name longer than 100 bytes", 1),
    ]


@pytest.mark.parametrize("parts", [1, 4])
def test_commits(spark, tmp_path, rows, parts):
    table = CommittedTable(spark, str(tmp_path / "t"), QUOTES_TABLE, parts)
    assert table.version == 0 and table.read().count() == 0 and table.read().columns == QUOTES_TABLE.columns
    first = [(i, 1, float(i), None, DAY) for i in range(20)] + [(None, 3, 1.0, None, DAY)]
    assert table.commit(quotes(spark, *first)) == 1
    assert rows(table.read()) == sorted(first, key=repr)
    # the new content is computed from what it replaces
    assert table.commit(table.read().withColumn("p_compra", F.col("p_compra") + 1)) == 2
    assert rows(table.read()) == sorted([(a, b, c + 1, d, e) for a, b, c, d, e in first], key=repr)
    reopened = CommittedTable(spark, str(tmp_path / "t"), QUOTES_TABLE, parts=99)
    assert reopened.parts == parts
    assert reopened.commit(reopened.read()) == 3
    assert rows(reopened.read()) == rows(table.read()) and table.read().count() == 21
    assert not list((tmp_path / "t").glob("_new-*"))


def files_of(folder):
    return {path: path.stat().st_mtime_ns for path in folder.rglob("part-*.parquet")}


def test_a_load_leaves_the_files_of_other_parts_alone(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"), QUOTES_TABLE, parts=8)
    table.commit(quotes(spark, *[(i, 1, 0.0, None, DAY) for i in range(40)]))
    before = files_of(tmp_path / "t")
    part = table.touched_by(quotes(spark, (5, 1, 1.0, None, DAY)))
    kept = {r.cripto_id for r in part.collect()}
    assert 5 in kept and len(kept) < 40
    table.commit(part.withColumn("p_compra", F.lit(7.0)))
    assert {r.cripto_id for r in table.read().where("p_compra = 7").collect()} == kept
    assert table.read().count() == 40
    after = files_of(tmp_path / "t")
    gone = {path.parent.name for path in before.keys() - after.keys()}
    assert len(gone) == 1 and all(after[path] == before[path] for path in before.keys() & after.keys())


def test_a_merge_reads_only_the_parts_it_touches(spark, tmp_path):
    """The scan is pruned while it runs: files of other parts are not opened, not even damaged ones."""
    table = CommittedTable(spark, str(tmp_path / "t"), QUOTES_TABLE, parts=8)
    table.commit(quotes(spark, *[(i, 1, 0.0, None, DAY) for i in range(40)]))
    poll = quotes(spark, (5, 1, 1.0, None, DAY), (5, 2, 1.0, None, DAY))
    frame = table.touched_by(poll)
    own = {r.f.split("/")[-1] for r in frame.select(F.input_file_name().alias("f")).distinct().collect()}
    assert 0 < len(own) < len(files_of(tmp_path / "t"))
    for path in files_of(tmp_path / "t"):
        if path.name not in own:
            path.write_bytes(b"damaged")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert 5 in {r.cripto_id for r in table.touched_by(poll).collect()}
    assert "dynamicpruning" in frame._jdf.queryExecution().executedPlan().toString()
    assert [r.cripto_id for r in table.part_of_key(F.lit(5)).where("cripto_id = 5").collect()] == [5]
    with pytest.raises(Exception, match="not a Parquet file"):
        table.read().collect()


@pytest.mark.parametrize("parts", [1, 4])
@pytest.mark.parametrize("moved", ["nothing", "some"])
def test_a_load_that_died_after_its_commit(spark, tmp_path, rows, monkeypatch, parts, moved):
    """It counts: readers see it whole, and the next load moves its parts."""
    table = CommittedTable(spark, str(tmp_path / "t"), QUOTES_TABLE, parts)
    table.commit(quotes(spark, *[(i, 1, 0.0, None, DAY) for i in range(20)]))
    new = quotes(spark, *[(i, 1, 1.0, None, DAY) for i in range(30)])
    with monkeypatch.context() as patch:
        patch.setattr(CommittedTable, "_settle", lambda self: None)
        assert table.commit(new) == 2
    if moved == "some":  # the move died half-way
        folder = next((tmp_path / "t" / "data").glob("_part=*"))
        for path in files_of(folder):
            path.unlink()
    assert rows(table.read()) == rows(new) and table.version == 2 and list((tmp_path / "t").glob("_new-*"))
    touched = table.touched_by(quotes(spark, (25, 1, 0.0, None, DAY)))
    assert touched.where("cripto_id = 25").first().p_compra == 1.0
    assert table.commit(None, batch=("s", 1)) == 3
    assert rows(table.read()) == rows(new) and not list((tmp_path / "t").glob("_new-*"))


def test_an_initial_load_writes_few_files(spark, tmp_path):
    """Many staged tasks into many parts: the inserted rows are brought together first."""
    source = spark.range(0, 2000, 1, 16).selectExpr(
        "cast(id as int) cripto_id", "1 broker_id", "1d p_compra", "1d p_venta",
        "timestamp_ntz'2024-01-01 00:00:00' fecha_cotizacion",
    )
    w = Warehouse(spark, str(tmp_path / "w"), parts=8)
    source.write.parquet(str(tmp_path / "s"))
    merge_staged_quotes(w, spark.read.parquet(str(tmp_path / "s")))
    files = list((tmp_path / "w").rglob("part-*.parquet"))
    assert w.quotes.read().count() == 2000 and len(files) == 8


def test_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"), QUOTES_TABLE)
    table.commit(quotes(spark, (1, 1, 1.0, None, DAY)))
    broken = table.read().withColumn("p_compra", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(PySparkException):
        table.commit(broken)
    assert table.version == 1 and table.read().first().p_compra == 1.0


def test_a_version_is_published_once(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"), QUOTES_TABLE)
    table.commit(quotes(spark, (1, 1, 1.0, None, DAY)))
    with pytest.raises(Exception, match="FileAlreadyExists"):
        table._publish(1, {"streams": {}, "parts": 1, "pending": None})
    assert table.read().count() == 1


def test_batches_are_remembered(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"), QUOTES_TABLE)
    row = quotes(spark, (1, 1, 1.0, None, DAY))
    assert not table.has_batch("s", 0)
    table.commit(row, batch=("s", 0))
    table.commit(row)
    assert table.has_batch("s", 0) and not table.has_batch("s", 1) and not table.has_batch("other", 0)


def test_sorted_inside_a_file(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"), QUOTES_TABLE, parts=2)
    table.commit(quotes(spark, *[(i % 5, 1, 0.0, None, date(2024, 1, 1 + (i * 7) % 28)) for i in range(100)]))
    seen = table.read().select(F.input_file_name().alias("f"), "fecha_cotizacion").collect()
    by_file = {}
    for r in seen:
        by_file.setdefault(r.f, []).append(r.fecha_cotizacion)
    assert all(days == sorted(days) for days in by_file.values())


def test_define_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS quotes_db")
    define_tables(spark, "quotes_db", buckets=4)
    define_tables(spark, "quotes_db", buckets=4)
    for spec in TABLES:
        assert spark.table(f"quotes_db.{spec.name}").columns == spec.columns
    details = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED quotes_db.cotizaciones").collect()}
    assert details["fecha_cotizacion"] == "date"
    assert details["Bucket Columns"] == "[`cripto_id`, `broker_id`]"
    assert details["Sort Columns"] == "[`fecha_cotizacion`]"
    names = {r.col_name: r.data_type for r in spark.sql("DESCRIBE quotes_db.stg_brokers").collect()}
    assert names["broker_name"] == "varchar(100)"
    broker_dimension(spark).write.insertInto("quotes_db.stg_brokers")
    define_tables(spark, "quotes_db")
    assert spark.table("quotes_db.stg_brokers").count() == 11
    define_tables(spark, "quotes_db", reset=True)
    assert spark.table("quotes_db.stg_brokers").count() == 0
    spark.sql("DROP DATABASE quotes_db CASCADE")


def test_load_catalog_tables(spark, tmp_path, rows):
    spark.sql("CREATE DATABASE load_db")
    row = staged(spark, (1, 1, 1.0, None, T1))
    load_table(row, STG_QUOTES, "load_db", "fail")
    with pytest.raises(ValueError, match="exists"):
        load_table(row, STG_QUOTES, "load_db", "fail")
    load_table(row, STG_QUOTES, "load_db")
    assert spark.table("load_db.stg_cotizaciones").count() == 2
    load_table(row, STG_QUOTES, "load_db", "replace")
    assert rows(spark.table("load_db.stg_cotizaciones")) == [(1, 1, 1.0, None, T1)]
    with pytest.raises(PySparkException, match="must not be NULL"):
        load_table(staged(spark, (1, 1, None, None, T1)), STG_QUOTES, "load_db")
    with pytest.raises(KeyError):
        load_table(row, STG_QUOTES, "load_db", "merge")
    spark.sql("DROP DATABASE load_db CASCADE")


@pytest.mark.parametrize("parts", [1, 4])
def test_a_commit_without_rows_changes_none(spark, tmp_path, rows, parts):
    table = CommittedTable(spark, str(tmp_path / "t"), QUOTES_TABLE, parts)
    table.commit(quotes(spark, (1, 1, 1.0, None, DAY), (2, 1, 2.0, None, DAY)))
    before = rows(table.read())
    assert table.commit(None, batch=("s", 3)) == 2
    assert rows(table.read()) == before and table.has_batch("s", 3)


def test_of_two_commits_with_one_base_the_second_fails(spark, tmp_path, rows):
    table = CommittedTable(spark, str(tmp_path / "t"), QUOTES_TABLE)
    table.commit(quotes(spark, (1, 1, 1.0, None, DAY)))
    base = table.version
    mine = quotes(spark, (1, 1, 1.0, None, DAY), (3, 1, 3.0, None, DAY))
    table.commit(table.read().union(quotes(spark, (2, 1, 2.0, None, DAY))))
    with pytest.raises(Exception, match="FileAlreadyExists"):
        table.commit(mine, base=base)
    assert [r[0] for r in rows(table.read())] == [1, 2]


def test_the_shuffled_merge_writes_few_files(spark, tmp_path):
    def staged_rows(shift):
        return spark.range(0, 3000, 1, 8).selectExpr(
            f"cast(id + {shift} as int) cripto_id", "1 broker_id", "1d p_compra", "1d p_venta",
            "timestamp_ntz'2024-01-01 00:00:00' fecha_cotizacion",
        )

    w = Warehouse(spark, str(tmp_path / "w"), parts=4)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        for n, shift in enumerate((0, 1000)):
            staged_rows(shift).write.parquet(str(tmp_path / f"s{n}"))
            merge_staged_quotes(w, spark.read.parquet(str(tmp_path / f"s{n}")), broadcast_source=False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert w.quotes.read().count() == 4000
    assert len(files_of(tmp_path / "w" / "cotizaciones")) == 4


def test_nan_is_missing(spark, rows):
    nan = float("nan")
    frame = staged(spark, (1, 1, nan, 1.0, T1))
    with pytest.raises(PySparkException, match="p_compra must not be NULL"):
        enforce(frame, STG_QUOTES).collect()
    assert rows(violations(frame, STG_QUOTES))[2] == ("stg_cotizaciones", "p_compra is NULL", 1)
    assert rows(enforce(staged(spark, (1, 1, 1.0, nan, T1)), STG_QUOTES)) == [(1, 1, 1.0, None, T1)]


def test_catalog_loads_write_a_file_per_bucket(spark, tmp_path):
    spark.sql("CREATE DATABASE bucket_db")
    define_tables(spark, "bucket_db", buckets=4)
    spark.range(0, 2000, 1, 16).selectExpr(
        "cast(id as int) cripto_id", "cast(id % 7 as int) broker_id", "1d p_compra", "1d p_venta",
        "date'2024-01-01' fecha_cotizacion",
    ).write.parquet(str(tmp_path / "q"))
    load_table(spark.read.parquet(str(tmp_path / "q")), QUOTES_TABLE, "bucket_db")
    table = spark.table("bucket_db.cotizaciones")
    assert table.count() == 2000
    files = table.select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 8
    layout = describe_layout(spark, STG_BROKERS, "bucket_db")
    assert layout == {
        "not_null": "broker_id",
        "distribution": "all",
        "bucket_columns": "",
        "buckets": "0",
        "sort_columns": "broker_id",
    }
    spark.sql("DROP DATABASE bucket_db CASCADE")


def test_latest_prices_of_a_bucketed_table(spark, tmp_path):
    """Buckets by coin: the newest row of every pair without a shuffle, and one bucket read for one coin."""
    spark.sql("CREATE DATABASE coin_db")
    define_tables(spark, "coin_db", buckets=4, by=("cripto_id",))
    spark.range(0, 2000, 1, 4).selectExpr(
        "cast(id % 50 as int) cripto_id", "cast(id % 7 as int) broker_id", "cast(id as double) p_compra", "1d p_venta",
        "date'2024-01-01' + cast(id % 90 as int) fecha_cotizacion",
    ).write.parquet(str(tmp_path / "q"))
    rows = spark.read.parquet(str(tmp_path / "q"))
    load_table(rows, QUOTES_TABLE, "coin_db")
    assert describe_layout(spark, QUOTES_TABLE, "coin_db")["bucket_columns"] == "cripto_id"
    table = spark.table("coin_db.cotizaciones")
    newest = latest_prices(table)
    assert sorted(newest.collect()) == sorted(latest_prices(rows).collect()) and newest.count() == 350
    assert "Exchange" not in newest._jdf.queryExecution().executedPlan().toString()
    wanted = latest_price(rows, 7, 0).collect()
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # so that the plan tells
    try:
        one = latest_price(table, 7, 0)
        assert one.collect() == wanted and "SelectedBucketsCount: 1 out of 4" in one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    own = {r.f.split("/")[-1] for r in table.where("cripto_id = 7").select(F.input_file_name().alias("f")).distinct().collect()}
    folder = next(iter(table.inputFiles())).removeprefix("file:").rsplit("/", 1)[0]
    for path in Path(folder).glob("part-*.parquet"):
        if path.name not in own:
            path.write_bytes(b"damaged")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert latest_price(table, 7, 0).collect() == wanted
    spark.sql("DROP DATABASE coin_db CASCADE")
