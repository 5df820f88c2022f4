"""Whole results: the star schema, the title reports, the daily ELT run."""
