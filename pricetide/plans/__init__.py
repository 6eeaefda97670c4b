"""Whole jobs: shard run, merge and publish, topic workbook, and the registered queries."""
