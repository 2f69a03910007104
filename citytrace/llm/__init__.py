"""Training-data operators: mixing, near-duplicates, filters, formatting, privacy, leaks, scores, token output."""
