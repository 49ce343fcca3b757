"""Training-data pipeline operators: quality, near duplicates, personal data, packing, tokens.

Nothing outside this folder imports it; ``queries.py`` holds the registered ``opN_*`` entries.
"""
