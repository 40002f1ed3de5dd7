"""Text and retrieval functions."""
