"""Training-data operators: filtering, deduplication, extraction, tokenisation and sharding of text corpora."""
