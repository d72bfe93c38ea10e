"""Ingest: Kafka-shaped records, payload decoding, zone reads, catalog."""
