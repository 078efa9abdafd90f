"""Relational operators of the posting pipeline."""
