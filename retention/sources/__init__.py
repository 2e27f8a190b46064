"""Sources and sinks: landing CSV files, partitioned Parquet tables, the test fixture."""
