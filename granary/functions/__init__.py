"""functions of the record engine."""
