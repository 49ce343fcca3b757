"""Checked queries over the driver tables: one Spark builder and one DuckDB oracle per key."""
