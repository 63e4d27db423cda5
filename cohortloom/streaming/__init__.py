"""Scoring requests as they arrive."""
