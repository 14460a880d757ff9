"""Structured Streaming forms of the raw-folder readers."""

from rawhouse.streaming.ingest import stream_entity_csvs, stream_posts, write_audited

__all__ = ["stream_entity_csvs", "stream_posts", "write_audited"]
