"""Operators of a training-data pipeline: deduplication, chat formatting,
language identification, tokenization and alignment, joins, scans, periodic runs,
packing and exact search.

Nothing else in the library imports this subpackage.  The registered queries
are in :mod:`marquee.llm.queries`.
"""
