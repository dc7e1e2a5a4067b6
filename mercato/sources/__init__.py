"""Sources and sinks: raw CSV (bronze), parquet layers, serving tables, test-table entity views."""
