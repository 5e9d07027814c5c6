"""Training-data operators: sharding, near-duplicates, classifiers, exact dedup, packing, search, archives, secrets, decontamination.

Nothing outside this subpackage imports it.
"""
