"""Structured Streaming: zone writers, pipeline runner, rollups, state."""
