"""Where matches come from: CSV files, staged Parquet, tables, derived fixtures."""
