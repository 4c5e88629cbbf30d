"""Training-data operators: quality, dedup, licences, toxicity, PII, chat, tokenizing and packing."""
