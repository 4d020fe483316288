"""Training-data operators: packing, quality rules, near-duplicate joins, language ID,
secret scans, vector search, sharding, chat formatting, source mixing, web archives.

Nothing else in the library imports this subpackage.  Arrow functions run in Python
workers, so the package has to be importable there (``--py-files`` on a cluster).
"""
