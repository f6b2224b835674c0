"""Composed plans: curation, quality gate, profiles."""
