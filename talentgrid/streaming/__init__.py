"""Long-running queries: matching, indicators and their outputs."""
