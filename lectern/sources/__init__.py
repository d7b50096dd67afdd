"""Sources of the keyed-text engine."""
