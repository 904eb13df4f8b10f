"""Training-data operators (deduplication, scans, scoring, tokenizing, packing). Nothing else in the library imports this."""
