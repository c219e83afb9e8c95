"""Reading and writing the raw and curated tables."""
