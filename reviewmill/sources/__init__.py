"""Readers and writers of review tables, word lists, vocabularies and vector files."""
