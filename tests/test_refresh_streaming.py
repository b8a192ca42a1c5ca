"""The full refresh over a warehouse folder, and incremental landing."""

from collections import Counter

from lakefold.plans.layers import Layers
from lakefold.plans.refresh import open_warehouse, refresh_all
from lakefold.session import fresh_path
from lakefold.streaming import land_delimited, land_documents

SF = "/root/testdata/sf0.001"
AS_OF = "2025-06-30 12:00:00"


def bag(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_refresh_all_matches_lazy_views(spark):
    wh = refresh_all(spark, SF, as_of=AS_OF)
    assert Counter(r.status for r in wh.audit.collect()) == {"START": 8, "SUCCESS": 8}
    L = Layers(spark, SF, as_of=AS_OF)
    assert bag(wh.views["vw_snt_notas_fiscais"]) == bag(L.invoice_summary())
    assert bag(wh.views["vw_snt_projetos_performance"]) == bag(L.project_task_hours)
    assert bag(wh.tables["log_sistema"]) == bag(L.system_log)
    assert spark.table("vw_dq_nota_fiscal_item").first().duplicatas_id_item == 0
    assert sorted(f.rstrip("/").rsplit("/", 1)[-1] for f in listed(spark, wh.root)) == ["audit", "bronze", "definitions", "silver"]  # no staging left
    # a second refresh of the same warehouse replaces everything, and views open without a rebuild
    again = refresh_all(spark, SF, root=wh.root, as_of=AS_OF)
    assert bag(again.tables["nota_fiscal"]) == bag(L.invoice)
    opened = open_warehouse(spark, wh.root, AS_OF).views["vw_snt_notas_fiscais"]
    assert bag(opened) == bag(L.invoice_summary())
    assert opened.inputFiles() and all("/silver/" in f for f in opened.inputFiles())


def listed(spark, path):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return [f.getPath().toString() for f in found]


def test_a_failing_source_spares_the_other_tables(spark):
    from lakefold.plans.catalog import write_source_files
    folder = fresh_path(spark, "t-files")
    write_source_files(Layers(spark, SF, as_of=AS_OF), folder)
    cut = spark.createDataFrame([("<NotasFiscais><NotaFiscal><Num",)], "v string")
    cut.coalesce(1).write.mode("append").text(f"{folder}/notas")
    wh = refresh_all(spark, files=folder, as_of=AS_OF)
    assert wh.failed == {"notas_fiscais", "notas_fiscais_json"}
    assert "nota_fiscal" not in wh.tables and "vw_snt_notas_fiscais" not in wh.views
    L = Layers(spark, SF, as_of=AS_OF)
    assert bag(wh.views["vw_anl_projetos"]) == bag(L.project_detail)
    assert bag(wh.tables["log_sistema"]) == bag(L.system_log)


def test_incremental_landing_is_exactly_once(spark):
    src, out, ckpt = (fresh_path(spark, n) for n in ("land-src", "land-out", "land-ckpt"))
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    df.coalesce(1).write.option("header", True).csv(f"{src}/batch1")
    q = land_delimited(spark, f"{src}/*", "id string, v string", out, ckpt)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([("3", "c")], "id string, v string").write.option("header", True).csv(f"{src}/batch2")
    land_delimited(spark, f"{src}/*", "id string, v string", out, ckpt).awaitTermination()
    land_delimited(spark, f"{src}/*", "id string, v string", out, ckpt).awaitTermination()   # nothing new
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_document_landing_one_row_per_file(spark):
    src, out, ckpt = (fresh_path(spark, n) for n in ("docs-src", "docs-out", "docs-ckpt"))
    spark.createDataFrame([("<a>1</a>",), ("<a>2</a>",)], "v string").coalesce(1).write.text(src)
    land_documents(spark, src, out, ckpt).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1 and rows[0].conteudo.splitlines() == ["<a>1</a>", "<a>2</a>"]


def test_tables_of_a_failing_load_are_not_built(spark, monkeypatch):
    from lakefold.plans import refresh

    def broken(pages):
        raise ValueError("Nenhuma tabela encontrada")

    monkeypatch.setitem(refresh._FORMATTED, "logs_sistema_table", ("logs_sistema", broken))
    wh = refresh_all(spark, SF, as_of=AS_OF)
    statuses = {(r.table_id, r.status) for r in wh.audit.collect()}
    assert ("logs_sistema_table", "ERROR") in statuses and ("clientes", "SUCCESS") in statuses
    assert "log_sistema" not in wh.tables and len(wh.tables) == 7
    assert "vw_snt_notas_fiscais" in wh.views


def test_misfits_are_set_aside_and_counted(spark):
    from lakefold.plans import refresh, sinks
    folder, root = fresh_path(spark, "t-misfits"), fresh_path(spark, "t-misfits-out")
    lines = ["id_analise|cliente_id|tipo_tributo|periodo_analise|valor_identificado|observacoes", "A1|C1|ISS|2024-Q1|1.5|ok", "A2|C1|ISS|2024-Q1|2.5",
             'A3|C1|ISS|2024-Q1|2.5|"a|b"', "A4|C1|ISS|2024-Q1|2.5|x|y", "A5|C1|ISS|2024-Q1|much|z", 'A6|C1|"I|S"|2024-Q1|bad|z', "A7|C1||||"]
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(f"{folder}/analises")
    loads = [ld for ld in refresh.loaders(spark, refresh.FileSources(spark, folder, keep_rejects=True), root, "t") if ld.table_id == "analises_tributarias"]
    audit = sinks.run_loads(spark, loads, root, f"{root}/_audit").collect()
    assert [(r.status, r.n_rows, r.n_rejected) for r in audit] == [("START", None, None), ("SUCCESS", 3, 4)]
    kept = sorted((r.id_analise, r.valor_identificado, r.observacoes) for r in sinks.read_table(spark, f"{root}/analises_tributarias").collect())
    assert kept == [("A1", 1.5, "ok"), ("A3", 2.5, "a|b"), ("A7", None, None)]
    bad = sorted(map(tuple, sinks.read_table(spark, f"{root}/analises_tributarias_rejects").collect()))
    assert bad == [(lines[2], "short"), (lines[4], "long"), (lines[5], "ill_typed"), (lines[6], "ill_typed")]
    strict = [ld for ld in refresh.loaders(spark, refresh.FileSources(spark, folder), root, "t") if ld.table_id == "analises_tributarias"]
    assert [r.status for r in sinks.run_loads(spark, strict, root, f"{root}/_audit2").collect()] == ["START", "ERROR"]
