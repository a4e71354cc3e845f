"""Denial-risk features, training, scoring, attribution and explanation."""
