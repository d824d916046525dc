"""Operators of a training-data pipeline (sharding, extraction, quality, PII,
toxicity, language-model scoring, decontamination, mixing, licenses,
near-duplicate join). Nothing outside this package imports it."""
