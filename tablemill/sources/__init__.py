"""sources of the text-record engine."""
