"""Functions of the keyed-text engine."""
