"""Training-data pipeline operators: near-duplicates, language, packing, privacy, secrets and token files."""
