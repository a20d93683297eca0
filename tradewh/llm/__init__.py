"""Training-data operators: scans, scores, packing, search and near-duplicates.

Nothing else in the library imports this subpackage. Every module holds one
operator with its own general interface; ``queries`` derives the registered
``opN_<name>`` results from them.
"""
