"""Operators for preparing training data: mixing, deduplication, labelling, archives, tokens, search.

Nothing outside this folder imports it.  Each operator takes DataFrames and column
names, works on narrow columns of its own and leaves other columns alone, so
extra columns of any name do no harm.
"""
