"""Training-data operators: formatting, deduplication, counting, scoring, packing, search and mixing."""
