"""Structured Streaming loaders that replace landed months as files arrive."""
