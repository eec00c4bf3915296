"""Training-data operators: deduplication, tokenising, mixing, scoring and filtering of documents."""
