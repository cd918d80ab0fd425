"""Readers of landed feeds and warehouse tables, and sinks."""
