"""Batch analytics operators; each is ``DataFrame -> DataFrame``."""
