"""Readers, writers and the ledger."""
