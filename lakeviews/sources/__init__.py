"""Sources and sinks: input tables, the raw CSV zone, curated parquet, exports."""
