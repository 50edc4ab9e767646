"""Structured Streaming: the live state fold over arriving snapshot files."""
