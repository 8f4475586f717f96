"""Inputs derived from the star-schema test tables, the registered queries, and their SQL twins."""
