"""Reference files as JSON and Parquet, reports and publication."""
