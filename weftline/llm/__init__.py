"""Operators for language-model training data: quality, defects, tokens, leakage, abuse, language, packing, spam."""
