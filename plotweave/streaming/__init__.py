"""Incremental processing as Structured Streaming: new files once, datum state by field, event windows."""
