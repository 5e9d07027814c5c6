"""Structured Streaming form of the text-put loader (S14 over a growing folder)."""
