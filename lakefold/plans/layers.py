"""The layers wired over a folder of driver tables.

``Layers(spark, sf_dir)`` exposes bronze stand-ins, silver tables and gold
views as lazily built DataFrames.  A property is built once per instance, so
a view that reads the same silver table twice shares one subtree (and Spark
reuses its exchange).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lakefold.plans import gold, quality, silver, standins
from lakefold.session import PACKED, brief_shuffles, fresh_path
from lakefold.sources.documents import INVOICE_FIELDS, TAX_FIELDS, invoice_elements, project_elements

# Fixed processing/check time for reproducible runs (stamps and future-date tests).
AS_OF = "2025-06-30 12:00:00"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Layers:
    """``stage=True``, for two and more tables of a document set, parses it once: the elements are
    written as a Parquet table under the shared scratch folder when first
    needed, and every table derived from them reads it back (with column
    pruning).  Several silver tables come from one parse, so this replaces
    repeated XML/JSON parsing with one write and cheap columnar reads, and it
    cuts the lineage a lost executor would otherwise have to recompute.
    ``stage=False`` is for one table: it is made while the documents are parsed,
    and of an invoice only its columns are kept."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str | None = AS_OF, stage: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.as_of = as_of
        self.stage = stage

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        if not self.stage:
            return df
        path = fresh_path(self.spark, f"staging-{name}")
        with brief_shuffles(self.spark):
            df.write.mode("overwrite").options(**PACKED).parquet(path)
        return self.spark.read.parquet(path)

    def stage_documents(self) -> "Layers":
        """For queries that read both document sets: their elements are written side by
        side, as two jobs, from one written copy of the order lines' columns they need."""
        if self.stage and not {"project_elements", "invoice_elements"} & self.__dict__.keys():
            self.__dict__["order_lines"] = self._staged(standins.order_lines(self.table("lineitem")), "line-parts")
            docs = (self.project_docs, self.invoice_docs)  # plans, made in one thread
            with ThreadPoolExecutor(max_workers=len(docs)) as pool:
                for job in [pool.submit(getattr, self, name) for name in ("project_elements", "invoice_elements")]:
                    job.result()
        return self

    def table(self, name: str) -> DataFrame:
        """The driver table ``name``; one DataFrame per table, so repeated reads
        share a scan node (and its file listing) within a plan."""
        cache = self.__dict__.setdefault("_tables", {})
        if name not in cache:
            cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return cache[name]

    # -- bronze stand-ins -------------------------------------------------
    @cached_property
    def customer_raw(self) -> DataFrame:
        return standins.customer_records(self.table("customer"), self.table("nation"))

    @cached_property
    def analysis_raw(self) -> DataFrame:
        return standins.analysis_records(self.table("events"))

    @cached_property
    def order_lines(self) -> DataFrame:
        return standins.order_lines(self.table("lineitem"))

    @cached_property
    def hot_orders(self) -> DataFrame | None:
        return standins.hot_orders(self.order_lines)

    @cached_property
    def project_docs(self) -> DataFrame:
        return standins.project_documents(self.table("orders"), self.order_lines, self.hot_orders)

    @cached_property
    def invoice_docs(self) -> DataFrame:
        return standins.invoice_documents(self.table("orders"), self.order_lines, self.hot_orders)

    @cached_property
    def log_pages(self) -> DataFrame:
        return standins.log_pages(self.table("events"))

    @cached_property
    def log_raw(self) -> DataFrame:
        return silver.log_table(self.log_pages, standins.LOG_HEADINGS)

    # -- silver -----------------------------------------------------------
    @cached_property
    def customer(self) -> DataFrame:
        return silver.customer(self.customer_raw, self.as_of)

    @cached_property
    def tax_analysis(self) -> DataFrame:
        return silver.tax_analysis(self.analysis_raw, self.as_of)

    @cached_property
    def project_elements(self) -> DataFrame:
        return self._staged(project_elements(self.project_docs), "project-elements")

    @cached_property
    def project(self) -> DataFrame:
        return silver.project(self.project_elements)

    @cached_property
    def task(self) -> DataFrame:
        return silver.task(self.project_elements)

    @cached_property
    def invoice_elements(self) -> DataFrame:
        return self._staged(invoice_elements(self.invoice_docs), "invoice-elements")

    def _invoices(self, columns) -> DataFrame:
        return self.invoice_elements if self.stage else invoice_elements(self.invoice_docs, columns)

    @cached_property
    def invoice(self) -> DataFrame:
        return silver.invoice(self._invoices(INVOICE_FIELDS))

    @cached_property
    def invoice_tax(self) -> DataFrame:
        return silver.invoice_tax(self._invoices(TAX_FIELDS))

    @cached_property
    def invoice_item(self) -> DataFrame:
        return silver.invoice_item(self._invoices(["Itens"]))

    @cached_property
    def system_log(self) -> DataFrame:
        return silver.system_log(self.log_raw, self.as_of)

    # -- gold -------------------------------------------------------------
    @cached_property
    def analysis_detail(self) -> DataFrame:
        return gold.analysis_detail(self.tax_analysis, self.customer)

    @cached_property
    def invoice_totals(self) -> DataFrame:
        return gold.invoice_totals(self.invoice, self.invoice_item, self.invoice_tax, exact=False)

    @cached_property
    def invoice_totals_exact(self) -> DataFrame:
        return gold.invoice_totals(self.invoice, self.invoice_item, self.invoice_tax, exact=True)

    @cached_property
    def project_detail(self) -> DataFrame:
        return gold.project_detail(self.project, self.task, self.customer)

    @cached_property
    def project_task_hours(self) -> DataFrame:
        return gold.project_task_hours(self.project, self.task, self.customer)

    @cached_property
    def project_longest_task(self) -> DataFrame:
        return gold.project_longest_task(self.project, self.task, self.customer)

    @cached_property
    def analysis_summary(self) -> DataFrame:
        return gold.analysis_summary(self.tax_analysis, self.customer)

    def invoice_summary(self, exact: bool = False) -> DataFrame:
        totals = self.invoice_totals_exact if exact else self.invoice_totals
        return gold.invoice_summary(totals, self.customer)

    # -- quality ----------------------------------------------------------
    def dq(self, name: str) -> DataFrame:
        fn, table = {
            "dq_customer": (quality.dq_customer, "customer"),
            "dq_analysis": (quality.dq_analysis, "tax_analysis"),
            "dq_project": (quality.dq_project, "project"),
            "dq_task": (quality.dq_task, "task"),
            "dq_invoice": (quality.dq_invoice, "invoice"),
            "dq_invoice_tax": (quality.dq_invoice_tax, "invoice_tax"),
            "dq_invoice_item": (quality.dq_invoice_item, "invoice_item"),
        }[name]
        return fn(getattr(self, table), self.as_of)

    # Views published by name, as the serving layer reads them.
    GOLD_VIEWS = {
        "vw_anl_analise_tributaria": "analysis_detail",
        "vw_anl_nota_fiscal": "invoice_totals",
        "vw_anl_projetos": "project_detail",
        "vw_snt_projetos_performance": "project_task_hours",
        "vw_snt_analises_tributarias": "analysis_summary",
        "vw_snt_notas_fiscais": "invoice_summary",
    }

    def gold_view(self, name: str) -> DataFrame:
        attr = self.GOLD_VIEWS[name]
        value = getattr(self, attr)
        return value() if callable(value) else value
