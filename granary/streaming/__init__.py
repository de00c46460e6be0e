"""streaming of the record engine."""
