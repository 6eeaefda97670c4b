"""DataFrame operators of the catalog pipeline."""
