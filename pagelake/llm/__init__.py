"""Training-data operators: language ID, decontamination, packing, suffix-array dedup, token counts,
toxicity, vector search, chat formatting, SimHash near-dedup and sharding."""
