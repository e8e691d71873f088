"""Operators for preparing training data: tokens, near-duplicates, filters, chat and packing.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when it is there.
"""
