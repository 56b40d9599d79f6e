"""Structured Streaming: ingest to Bronze (T2), latest-wins upsert into
Silver (T3), and replay of stored readings as events (T1)."""
