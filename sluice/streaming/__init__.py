"""Structured Streaming ingestion of feed folders (micro-batch keyed loads)."""

from sluice.streaming.feed_stream import load_micro_batch, read_feed_stream, stream_feed

__all__ = ["load_micro_batch", "read_feed_stream", "stream_feed"]
