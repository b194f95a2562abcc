"""Operators for training-data corpora: archives, mixing, packing, search, language,
quality, language-model scores, near and line duplicates, licenses."""
