"""Structured Streaming: sinks, foreachBatch handlers, query life cycle and progress."""
