"""Refresh on arrival of new data, and its log."""
