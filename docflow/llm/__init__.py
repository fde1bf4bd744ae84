"""Corpus operators for language-model training data (deduplication, archives,
tokenisers, filters, sharding). Nothing outside this folder imports it."""
