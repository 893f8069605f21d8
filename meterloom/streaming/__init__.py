"""Structured Streaming forms of the stream accounting and of the job watcher."""
