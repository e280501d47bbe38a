"""Structured Streaming: exactly-once pickup of newly landed raw exports."""
