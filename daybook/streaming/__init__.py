"""Incremental runs driven by Structured Streaming over the Bronze landing folder."""
