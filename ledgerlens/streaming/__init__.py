"""Incremental runs: watermarked deduplication, late rows, triggered execution."""
