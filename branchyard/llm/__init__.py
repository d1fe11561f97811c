"""Operators that prepare training text: tokens, archives, search, filters, duplicates."""
