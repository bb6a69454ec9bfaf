"""Structured Streaming jobs. A checkpoint location is mandatory in all of them."""
