"""Serving guards, JSON rows, partition refresh."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakefold.plans import serving, sinks
from lakefold.session import fresh_path


def test_read_view_validates_name_and_limit(spark):
    views = {"vw_a": lambda: spark.range(10).withColumnRenamed("id", "k")}
    assert serving.read_view(views, "VW_A", 3, order_by=("k",)).count() == 3
    for bad in (0, 1001, "5", True):
        with pytest.raises(ValueError):
            serving.read_view(views, "vw_a", bad)
    with pytest.raises(serving.ViewNotFound):
        serving.read_view(views, "vw_b")
    assert serving.list_views({"b": 1, "a": 2}) == ["a", "b"]


def test_rows_as_json_dates_and_decimals(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 3, None, "3.00"), (dt.date(2024, 1, 3), 4, "x", "3.50")],
                               "d date, n int, s string, m string").withColumn("m", F.col("m").cast("decimal(10,2)"))
    js = [r.json for r in serving.rows_as_json(df).orderBy("json").collect()]
    assert js == ['{"d":"2024-01-02","n":3,"s":null,"m":3}', '{"d":"2024-01-03","n":4,"s":"x","m":3.5}']


def test_dynamic_partition_overwrite_keeps_other_days(spark):
    path = fresh_path(spark, "t-part")
    a = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "k int, d date")
    sinks.partitioned_write(a, path, "d")
    b = spark.createDataFrame([(3, dt.date(2024, 1, 2))], "k int, d date")
    out = sinks.replace_dates(b, path, "d")
    assert sorted((r.k, str(r.d)) for r in out.collect()) == [(1, "2024-01-01"), (3, "2024-01-02")]
    assert out.where(F.col("d") == dt.date(2024, 1, 1)).count() == 1


def test_audit_csv_keeps_multiline_messages_and_isolates_failures(spark):
    root = fresh_path(spark, "t-audit")
    ok = sinks.Loader("load_raw_csv", "t_ok", "src-a", lambda: spark.range(3))
    bad = sinks.Loader("load_raw_x", "t_bad", "src-b",
                       lambda: spark.range(1).select(F.raise_error(F.lit('broken "quoted"\nsecond line'))))
    after = sinks.Loader("load_raw_txt", "t_after", "src-c", lambda: spark.range(2))
    audit = sinks.run_loads(spark, [ok, bad, after], f"{root}/bronze", f"{root}/audit.csv", audit_format="csv")
    assert [(r.table_id, r.status, r.n_rows) for r in audit.collect()] == [
        ("t_ok", "START", None), ("t_ok", "SUCCESS", 3), ("t_bad", "START", None), ("t_bad", "ERROR", None),
        ("t_after", "START", None), ("t_after", "SUCCESS", 2)]
    back = sinks.read_audit(spark, f"{root}/audit.csv").collect()
    assert len(back) == 6 and all(r.logged_at is not None for r in back)
    err = [r.message for r in back if r.status == "ERROR"][0]
    assert 'broken "quoted"' in err and "second line" in err


def test_read_audit_accepts_naive_and_offset_timestamps(spark):
    path = fresh_path(spark, "t-audit-forms")
    import os
    os.makedirs(path)
    with open(f"{path}/log.csv", "w", encoding="utf-8") as fh:
        fh.write('timestamp,operation,table_id,status,message\n'
                 '2025-10-27T02:06:12.939658,run_ddl,t,START,ok\n'
                 '2025-10-27T02:06:13.872785,run_ddl,t,ERROR,"Falha: Expected "")"" or "",""\n\nLocation: US\n"\n'
                 '2025-10-27T02:09:30.886949+00:00,run_ddl,t,START,ok\n')
    rows = sinks.read_audit(spark, path).collect()
    assert [r.status for r in rows] == ["START", "ERROR", "START"]
    assert all(r.logged_at is not None for r in rows)
    assert rows[1].message.startswith('Falha: Expected ")" or ","') and "Location: US" in rows[1].message


def test_failed_schema_setup_stops_the_run(spark):
    root = fresh_path(spark, "t-setup")
    ran = []

    def broken():
        raise ValueError("Syntax error at [54:3]")

    loader = sinks.Loader("load_raw_csv", "t", "src", lambda: ran.append(1) or spark.range(1))
    with pytest.raises(sinks.SetupFailed):
        sinks.run_loads(spark, [loader], f"{root}/bronze", f"{root}/audit", setup=("ddl.sql", broken))
    audit = spark.read.parquet(f"{root}/audit").orderBy("seq").collect()
    assert [(r.operation, r.status) for r in audit] == [("run_ddl_script", "START"), ("run_ddl_script", "ERROR")]
    assert ran == []


def test_conform_casts_to_declared_schema(spark):
    df = spark.createDataFrame([("1", "2.5", "x")], "a string, b string, extra string")
    out = sinks.conform(df, "b double, a string")
    assert out.columns == ["b", "a"] and out.first() == (2.5, "1")


def test_drop_scratch_removes_only_newer_folders(spark):
    import os
    from lakefold.session import drop_scratch, scratch_mark
    keep = fresh_path(spark, "t-keep")
    spark.range(1).write.parquet(keep)
    mark = scratch_mark()
    gone = fresh_path(spark, "t-gone")
    spark.range(1).write.parquet(gone)
    drop_scratch(spark, mark)
    assert os.path.isdir(keep.replace("file:", "")) and not os.path.exists(gone.replace("file:", ""))


def test_cli_lists_views(capsys):
    from lakefold.__main__ import main
    assert main(["views"]) == 0
    assert capsys.readouterr().out.split() == sorted(
        ["vw_anl_analise_tributaria", "vw_anl_nota_fiscal", "vw_anl_projetos", "vw_snt_projetos_performance",
         "vw_snt_analises_tributarias", "vw_snt_notas_fiscais"])


def test_rows_as_json_nested_decimals(spark):
    df = spark.sql("SELECT named_struct('a', CAST(2 AS DECIMAL(5,1)), 'b', array(CAST(1.5 AS DECIMAL(5,2)))) AS s")
    assert serving.rows_as_json(df).first().json == '{"s":{"a":2,"b":[1.5]}}'


def test_partitioned_refresh_replaces_the_whole_table(spark):
    path = fresh_path(spark, "t-replace")
    rows = lambda *days: spark.createDataFrame([(k, dt.date(2024, 1, d)) for k, d in enumerate(days)], "k int, d date")
    assert sinks.partitioned_write(rows(1, 2), path, "d").count() == 2
    assert [r.d.day for r in sinks.partitioned_write(rows(2), path, "d").collect()] == [2]
    assert sorted(r.d.day for r in sinks.replace_dates(rows(3, 3), path, "d").collect()) == [2, 3, 3]
    empty = sinks.partitioned_write(rows(1).limit(0), path, "d")
    assert empty.columns == ["k", "d"] and empty.count() == 0


def test_a_failed_refresh_leaves_the_old_table(spark):
    path = fresh_path(spark, "t-atomic")
    sinks.refresh_table(spark.range(3), path)
    with pytest.raises(Exception):
        sinks.refresh_table(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert sinks.read_table(spark, path).count() == 3


def test_a_reader_always_finds_a_table(spark):
    path = fresh_path(spark, "t-switch")
    assert sinks.current_version(spark, path) is None
    sinks.refresh_table(spark.range(3), path)
    seen = []

    def write(new):  # a reader in the middle of a write
        spark.range(5).write.parquet(new)
        seen.append(sinks.read_table(spark, path).count())

    sinks._replace(spark, path, write)
    assert seen == [3] and sinks.read_table(spark, path).count() == 5
    begun = sinks.read_table(spark, path)  # this reader goes on with its version after the next write
    sinks.refresh_table(spark.range(7), path)
    assert begun.count() == 5 and sinks.read_table(spark, path).count() == 7
    sinks.refresh_table(spark.range(8), path)
    assert len(sinks._versions(spark, path)) == sinks.KEEP  # older ones have gone
    folders = [f.getPath().getName() for f in sinks._fs(spark, path)[0].listStatus(sinks._fs(spark, path)[1])]
    assert len([f for f in folders if f.startswith("v")]) == sinks.KEEP
    plain = fresh_path(spark, "t-plain")
    spark.range(2).write.parquet(plain)
    assert sinks.read_table(spark, plain).count() == 2


def test_a_failed_load_keeps_the_last_version(spark):
    root = fresh_path(spark, "t-load-versions")
    load = lambda df: sinks.run_loads(spark, [sinks.Loader("load_raw_csv", "t", "src", lambda: df)], root, f"{root}/_audit",
                                      setup=("ddl", lambda: sinks.setup_tables(spark, root, {"t": "id bigint"})))
    load(spark.range(4))
    load(spark.range(2).select((F.col("id") + F.raise_error(F.lit("no")).cast("bigint")).alias("id")))
    assert sinks.read_table(spark, f"{root}/t").count() == 4
    sinks.setup_tables(spark, root, {"t": "id bigint, other string"})  # other columns: an empty table
    assert sinks.read_table(spark, f"{root}/t").columns == ["id", "other"]


def test_clustered_files_hold_narrow_ranges(spark):
    path = fresh_path(spark, "t-clustered")
    df = spark.range(40000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("v"))
    hot = spark.range(40000, 60000).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("v"))  # one key with a third of the rows
    out = sinks.clustered_write(df.union(hot), path, ["k"])
    files = out.groupBy(F.col("_metadata.file_name")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n")).collect()
    spans = sorted((r.lo, r.hi) for r in files)
    assert len(files) > 3 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert max(r.n for r in files) < 60000 / len(files) * 2


def test_json_timestamps_have_a_fraction_only_where_there_is_one(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 12:00:00' AS a, TIMESTAMP_NTZ'2024-01-02 12:00:00.5' AS b, CAST(3 AS DECIMAL(9,2)) AS c")
    assert serving.rows_as_json(df).first().json == '{"a":"2024-01-02T12:00:00","b":"2024-01-02T12:00:00.500000","c":3}'
