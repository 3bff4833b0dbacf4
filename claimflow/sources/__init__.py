"""Sources and sinks: typed Parquet scans, adapters over the driver tables, files."""
