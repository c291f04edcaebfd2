"""Storage: the Parquet table store, file-system helpers, declared schemas and fixtures."""
