"""Corpus operators for training data: encoding, packing, cleaning and duplicate search.

Nothing outside this subpackage imports it; `__spark_entry__` adds its queries only when it is there.
"""
