"""Writers for shards, catalog tables, link files and reports."""
