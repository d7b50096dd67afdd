"""Streaming of the keyed-text engine."""
