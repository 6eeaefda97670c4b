"""Readers for sitemaps, link files, listing responses, pages and shop tables."""
