"""Streaming forms: file replay, watermarked operators, stateful processors."""
