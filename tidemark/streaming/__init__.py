"""tidemark.streaming."""
