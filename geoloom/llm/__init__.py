"""Operators for training-data pipelines over documents (doc_id, text, lang, source)."""
