"""plans of the text-record engine."""
