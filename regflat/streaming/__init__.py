"""Structured Streaming front for the incremental load (L1-L3)."""
