"""functions of the text-record engine."""
