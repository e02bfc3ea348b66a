"""Training-data operators: tokenising, packing, ordering, sharding, nearest
neighbours, near-duplicates, language, quality, URL filters and web archives.

Nothing else in the library imports this subpackage. ``queries`` registers one
``opN_<name>`` query per operator.
"""
