"""Test inputs and DuckDB twins for the registered queries."""
