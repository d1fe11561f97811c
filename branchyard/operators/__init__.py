"""Ref, table, merge and audit operators."""
