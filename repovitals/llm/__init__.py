"""Operators for preparing training text: filters, joins, fingerprints, mixing and encoding at scale."""
