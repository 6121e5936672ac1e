"""Sources and sinks: catalog / Parquet tables, delimited snapshots, the SQL surface."""
