"""Reusable relational building blocks: quality, audit, lookups, windows, keys."""
