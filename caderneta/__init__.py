"""Caderneta: commercial report data as Spark DataFrames.

Sales and purchase reports in, a clean table of sales items, KPIs and BI files
out.  Every operator takes and returns DataFrames and is lazy; only the sinks and
``run_pipeline`` start jobs.
"""

from caderneta.operators.calendar import (
    mark_scope,
    period_overlaps,
    seasonality_index,
    sunday_sales,
    supersede_partial,
)
from caderneta.operators.consolidate import consolidate, consolidation_report
from caderneta.operators.kpis import (
    compute_kpis,
    kpi_bundle,
    kpi_global,
    sales_by_month,
    top_products,
)
from caderneta.operators.quality import duplicate_ids, validate
from caderneta.operators.report_fixed import (
    analytic_sales,
    purchases,
    synthetic_sales,
)
from caderneta.operators.report_grid import flat_items, hierarchical_items
from caderneta.operators.standardize import standardize
from caderneta.plans.audit import append_audit, audit_summary
from caderneta.plans.pipeline import run_pipeline
from caderneta.session import build_session
from caderneta.sinks.files import (
    export_bi_csv,
    export_csv,
    export_json,
    export_parquet,
)
from caderneta.sinks.report import export_markdown, kpi_report_lines
from caderneta.sources.grid import ingest_grid, read_grid
from caderneta.sources.report_text import (
    read_analytic_sales,
    read_purchases,
    read_report_lines,
    read_synthetic_sales,
)

__all__ = [name for name in dir() if not name.startswith("_")]
