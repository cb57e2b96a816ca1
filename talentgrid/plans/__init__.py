"""End-to-end pipelines put together from sources, operators and sinks."""
