"""streaming of the text-record engine."""
