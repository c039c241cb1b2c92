"""Writes: catalog tables under every load mode, and delimited extracts."""
