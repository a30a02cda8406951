"""Training-data operators: secrets, decontamination, near-dedup, language, URLs, WARC, quality, toxicity, packing."""
