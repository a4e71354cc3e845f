"""Composed jobs: Bronze, Silver, Gold, marts, metric layer, end-to-end run."""
