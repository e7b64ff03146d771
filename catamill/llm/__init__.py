"""Operators of a training-data pipeline: media, tokens, language, extraction, scoring, joins, filters and packing."""
