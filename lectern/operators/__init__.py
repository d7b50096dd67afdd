"""Operators of the keyed-text engine."""
