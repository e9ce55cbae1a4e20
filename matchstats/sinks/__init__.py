"""Where results go: staged Parquet, the typed table, views and marts."""
