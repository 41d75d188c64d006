"""Readers for raw text, landed pages and stored tables."""
