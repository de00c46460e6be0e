"""plans of the record engine."""
