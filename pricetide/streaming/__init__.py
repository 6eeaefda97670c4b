"""Incremental append of newly arrived shard tables."""
