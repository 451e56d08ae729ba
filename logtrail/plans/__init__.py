"""Whole plans: Bronze collection, Silver, Gold."""
