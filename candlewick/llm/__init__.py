"""Training-data operators."""
