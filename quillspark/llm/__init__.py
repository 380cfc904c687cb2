"""Training-data operators: media, near-dedup, secrets, languages, PII, token files, and scores."""
