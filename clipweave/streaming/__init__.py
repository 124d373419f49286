"""Structured Streaming facades."""
