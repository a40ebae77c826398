"""Scans: text, web archives, genome files, streams."""
