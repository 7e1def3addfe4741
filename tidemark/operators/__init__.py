"""tidemark.operators."""
