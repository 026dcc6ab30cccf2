"""Cross-domain analytics on Spark.

Raw business datasets (sales, HR, finance, inventory, marketing) are landed,
coerced, de-duplicated and quality-checked, modelled as a star schema and
queried through five cross-domain views.  Every step is a Spark DataFrame
plan; nothing is collected to the driver except scalars that steer control
flow.

Sub-packages:
  sources    scans and sinks (driver tables, raw CSV zone, curated parquet)
  functions  column-expression builders (coercion, rounding, text helpers)
  operators  table-level operators (dedupe, quality checks)
  plans      star schema, views, joins, named queries, text jobs, catalogue, the full job
"""

from lakeviews.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
