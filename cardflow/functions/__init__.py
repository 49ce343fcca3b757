"""Column-level building blocks: dates, text normalisation, decodes and rule chains."""
