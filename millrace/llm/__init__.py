"""Training-data operators: extraction, filtering, tokenising, scoring, deduplication, mixing."""
