"""Training-data operators: filters, deduplication, tokenization, search and archives."""
