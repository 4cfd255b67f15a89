"""Training-data operators: quality, chat, dedup, tokens, secrets, packing, toxicity, models, mixing."""
