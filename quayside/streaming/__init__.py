"""Structured Streaming form of the dated-file load (the reference itself is batch only)."""
