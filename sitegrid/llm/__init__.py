"""Training-data operators: deduplication, decontamination, filters, tokens, scores."""
