"""Operators for text corpora of language models. Nothing outside this subpackage imports it."""
