"""DataFrame to DataFrame operators, the same for batch and streaming input."""
