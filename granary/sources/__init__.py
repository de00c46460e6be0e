"""sources of the record engine."""
