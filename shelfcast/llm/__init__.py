"""Training-data operators: tokenising, sharding, deduplication, archives, scans and mixing.

Each module holds one operator with its own general interface; ``queries``
registers the thin queries over the standard tables.
"""
