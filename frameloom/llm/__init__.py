"""Operators for preparing training text: filters, near duplicates, archives, tokens and search."""
