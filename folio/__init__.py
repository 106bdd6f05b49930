"""Folio: turns documents into lean, checked context for language models, on Spark."""
