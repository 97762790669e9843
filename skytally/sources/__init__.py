"""Readers for message logs and helpers that expose them as SQL views."""
