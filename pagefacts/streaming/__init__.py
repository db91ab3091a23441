"""Structured Streaming jobs over arriving page tables."""
