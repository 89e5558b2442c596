"""Readers of raw exports, and writers of the canonical tables."""
