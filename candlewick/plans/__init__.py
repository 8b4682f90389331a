"""Job compositions: incremental load, end-to-end pipeline, query registry."""
