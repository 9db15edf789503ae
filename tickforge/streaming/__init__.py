"""Structured Streaming jobs (T1-T13): the batch operators re-used on
streams, plus keyed state where window functions are not allowed."""
