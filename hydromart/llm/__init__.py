"""Training-data operators: dedup, tokenisation, extraction, privacy, secrets, quality, decontamination."""
