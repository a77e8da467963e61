"""Operators for building training corpora: sharding, dedup, quality, language, archives, decontamination, tokens, packing, secrets."""
