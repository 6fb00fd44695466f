"""Operators over corpora, windows, vocabularies and models."""
