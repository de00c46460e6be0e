"""operators of the record engine."""
