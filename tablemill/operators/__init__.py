"""operators of the text-record engine."""
