"""Training-data operators: sharding, de-duplication, filtering, packing and token files.

Each module holds one operator with its own general interface; ``queries``
registers the ``opN_*`` queries built on them.
"""
