"""Relation-level operators: validity filters, joins, top-1 per key, set ops and report sorts."""
