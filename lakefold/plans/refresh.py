"""A full refresh: land bronze, build silver, publish gold and quality views.

The counterpart of the reference's run (load script, then the silver and view
scripts), as Spark jobs over a warehouse folder:

* bronze: a schema-setup step (stops the run if it fails), then the five raw
  loads side by side and the two formatted ones from the landed raw tables,
  with an audit trail; a failing source is logged and the others continue;
* silver: the invoice and project documents are each parsed once into a
  staging table, from which invoices, taxes and items (and projects and
  tasks) are derived; the tables are written side by side with the
  reference's layout (date partitions, clustering; invoices, taxes and items in
  buckets of the invoice key), and staging is deleted.
  Tables whose source failed keep their last version;
* gold and quality: views over the stored silver tables, kept as SQL text beside
  them (``view_sql.py``), so every read prunes columns and partitions at the Parquet
  scan.  ``open_warehouse`` defines them in any later session without building anything.

A table is replaced as a whole once its new version is complete, and readers find the
old one until then, so re-running after a failure ends in the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.fixed import LOADS
from lakefold.plans import silver, sinks, standins, view_sql
from lakefold.plans.layers import Layers
from lakefold.plans.schemas import BRONZE_SCHEMAS
from lakefold.plans.warehouse import Warehouse, bucketed_write, open_warehouse, store_definitions
from lakefold.session import brief_shuffles, fresh_path
from lakefold.sources.documents import invoice_elements, project_elements, xml_to_json
from lakefold.sources.files import scan_csv, scan_delimited, scan_documents
from lakefold.sources.records import scan_json_documents, scan_xml_documents

# Raw loads read a source; formatted loads read a landed raw table.
_RAW = {"clientes": "customer_raw", "analises_tributarias": "analysis_raw", "tarefas_projetos": "project_docs",
        "notas_fiscais": "invoice_docs", "logs_sistema": "log_pages"}
_FORMATTED = {"notas_fiscais_json": ("notas_fiscais", xml_to_json),
              "logs_sistema_table": ("logs_sistema", lambda pages: silver.log_table(pages, standins.LOG_HEADINGS))}

INVOICES_IN_BUCKET = 100_000
INVOICES_IN_FILE = 400  # on average: a file of the invoices is a bucket of a date, and tiny ones cost time and space


def bucket_count(invoices: int, dates: int, most: int) -> int:
    """Buckets of the invoice tables: one for each INVOICES_IN_BUCKET invoices, but no more than leave
    INVOICES_IN_FILE for each file of the table that has a folder for each date."""
    return max(1, min(most, -(-invoices // max(INVOICES_IN_BUCKET, dates * INVOICES_IN_FILE))))


# Silver table -> the bronze table it is built from.
_BUILT_FROM = {"cliente": "clientes", "analise_tributaria": "analises_tributarias", "projeto": "tarefas_projetos",
               "tarefa": "tarefas_projetos", "nota_fiscal": "notas_fiscais", "nota_fiscal_imposto": "notas_fiscais",
               "nota_fiscal_item": "notas_fiscais", "log_sistema": "logs_sistema_table"}


class FileSources:
    """The five raw sources as files under one folder, read with declared schemas:
    ``clientes`` (comma-delimited), ``analises`` (pipe-delimited), ``projetos`` (JSON
    documents), ``notas`` (XML documents) and ``logs`` (HTML pages), a file or a folder
    of files each.  A JSON or XML file may be large: it is read in several tasks, and each
    project and invoice in it becomes a document.  An HTML file is one document.  With
    ``keep_rejects``, rows of delimited files that do not fit the declared columns are set
    aside in ``<table>_rejects`` and counted in the audit; else they fail the load."""

    def __init__(self, spark: SparkSession, folder: str, keep_rejects: bool = False, scratch: str | None = None):
        self.spark, self.folder, self.scratch = spark, folder.rstrip("/"), scratch
        self.separators = {"clientes": ",", "analises_tributarias": "|"} if keep_rejects else {}

    def _delimited(self, folder: str, table: str, sep: str) -> DataFrame:
        scan = scan_delimited if self.separators else scan_csv
        return scan(self.spark, f"{self.folder}/{folder}", BRONZE_SCHEMAS[table], sep)

    @property
    def customer_raw(self) -> DataFrame:
        return self._delimited("clientes", "clientes", ",")

    @property
    def analysis_raw(self) -> DataFrame:
        return self._delimited("analises", "analises_tributarias", "|")

    @property
    def project_docs(self) -> DataFrame:
        return scan_json_documents(self.spark, f"{self.folder}/projetos", "projetos", self.scratch).select("doc_id", "conteudo")

    @property
    def invoice_docs(self) -> DataFrame:
        return scan_xml_documents(self.spark, f"{self.folder}/notas", "NotaFiscal").select("doc_id", "conteudo")

    @property
    def log_pages(self) -> DataFrame:
        return scan_documents(self.spark, f"{self.folder}/logs").select("doc_id", "conteudo")


def loaders(spark: SparkSession, sources, root: str, source_name: str) -> list[sinks.Loader]:
    """The seven loads in their order; ``sources`` has the raw frames as attributes."""
    out = []
    for operation, table in LOADS:
        schema = BRONZE_SCHEMAS[table]
        if table in _RAW:
            sep = getattr(sources, "separators", {}).get(table)
            build = ((lambda t=table: getattr(sources, _RAW[t])) if sep else
                     (lambda t=table, s=schema: sinks.conform(getattr(sources, _RAW[t]), s)))
            out.append(sinks.Loader(operation, table, f"{source_name}:{table}", build, sep=sep))
        else:
            raw, make = _FORMATTED[table]
            build = lambda r=raw, m=make, s=schema: sinks.conform(m(sinks.read_table(spark, f"{root}/{r}", BRONZE_SCHEMAS[r])), s)
            out.append(sinks.Loader(operation, table, f"{source_name}:{table}", build, after=raw))
    return out


def _concurrently(jobs: dict, max_parallel: int = 4) -> dict:
    """Run independent write jobs side by side; results keep the keys of ``jobs``."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def refresh_all(spark: SparkSession, sf_dir: str | None = None, root: str | None = None,
                as_of: str | None = None, files: str | None = None, keep_rejects: bool = False, buckets: int | None = None) -> Warehouse:
    """Refresh from the driver tables in ``sf_dir``, or from the source files in the folder ``files``
    (``keep_rejects``: see ``FileSources``).  Invoices, taxes and items are stored in ``buckets`` of their
    key: unless given, see ``bucket_count``, up to the number of shuffle partitions."""
    root = root or fresh_path(spark, "warehouse")
    scratch = f"{root}/_scratch"  # of the readers, until their tables are landed
    sources, name = (FileSources(spark, files, keep_rejects, scratch), files) if files else (Layers(spark, sf_dir, as_of=as_of), "stand-in")
    audit = sinks.run_loads(spark, loaders(spark, sources, f"{root}/bronze", name), f"{root}/bronze", f"{root}/audit",
                            setup=("bronze_schemas",
                                   lambda: sinks.setup_tables(spark, f"{root}/bronze", BRONZE_SCHEMAS)))
    sinks.drop_folder(spark, scratch)
    failed = {r.table_id for r in audit.where(F.col("status") == "ERROR").select("table_id").collect()}
    read = lambda n: sinks.read_table(spark, f"{root}/bronze/{n}", BRONZE_SCHEMAS[n])
    staging, s = f"{root}/_staging", f"{root}/silver"
    parsers = [(n, p) for n, p in (("notas_fiscais", invoice_elements), ("tarefas_projetos", project_elements)) if n not in failed]
    parsed = sinks.run_loads(spark, [sinks.Loader("parse_documents", n, f"bronze:{n}", lambda n=n, p=p: p(read(n))) for n, p in parsers],
                             staging, f"{root}/audit")  # a document that cannot be read fails its tables, not the run
    failed |= {r.table_id for r in parsed.where(F.col("status") == "ERROR").select("table_id").collect()}
    nf, prj = (sinks.read_table(spark, f"{staging}/{n}") if n not in failed else None for n in ("notas_fiscais", "tarefas_projetos"))
    if nf is not None and not buckets:
        with brief_shuffles(spark):
            size = nf.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("DataEmissao").alias("dates")).first()
        buckets = bucket_count(size["n"], size["dates"], int(spark.conf.get("spark.sql.shuffle.partitions")))
    jobs = {
        "cliente": lambda: sinks.refresh_table(silver.customer(read("clientes"), as_of), f"{s}/cliente"),
        "analise_tributaria": lambda: sinks.refresh_table(
            silver.tax_analysis(read("analises_tributarias"), as_of), f"{s}/analise_tributaria"),
        "projeto": lambda: sinks.refresh_table(silver.project(prj), f"{s}/projeto"),
        "tarefa": lambda: sinks.clustered_write(silver.task(prj), f"{s}/tarefa", ["id_projeto"]),
        "nota_fiscal": lambda: bucketed_write(silver.invoice(nf), f"{s}/nota_fiscal", "id_nota", buckets, partition_by="data_emissao"),
        "nota_fiscal_imposto": lambda: bucketed_write(silver.invoice_tax(nf), f"{s}/nota_fiscal_imposto", "id_nota", buckets, ["tipo_imposto"]),
        "nota_fiscal_item": lambda: bucketed_write(silver.invoice_item(nf), f"{s}/nota_fiscal_item", "id_nota", buckets),
        "log_sistema": lambda: sinks.partitioned_write(silver.system_log(read("logs_sistema_table"), as_of),
                                                       f"{s}/log_sistema", "data_evento", cluster_by=("usuario", "acao")),
    }
    _concurrently({n: job for n, job in jobs.items() if _BUILT_FROM[n] not in failed})
    sinks.drop_folder(spark, staging)
    store_definitions(spark, root, view_sql.FUNCTIONS, view_sql.VIEWS)
    wh = open_warehouse(spark, root, as_of)
    wh.audit, wh.failed = audit, failed
    return wh


__all__ = ["refresh_all", "open_warehouse", "loaders", "FileSources", "Warehouse"]
