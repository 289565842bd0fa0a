"""Structured Streaming: decode, windowed counts, keyed upserts, dead-letter split."""
