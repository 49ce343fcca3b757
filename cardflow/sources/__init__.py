"""Reading inputs: parquet folders, catalog tables, SQL text and JDBC (SRC-1..SRC-4)."""
