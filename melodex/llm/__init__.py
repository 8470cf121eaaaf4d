"""Training-data operators: mixing, near duplicates, sharding, filters, language, tokens, vector search."""
