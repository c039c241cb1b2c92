"""Scans: delimited files (local or object store), dated file sets, catalog tables, SQL files."""
