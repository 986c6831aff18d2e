"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``embeddings``.

Each module holds one operator with its own general interface; ``queries`` binds
them to the registered ``opN_<name>`` queries. Nothing outside this subpackage
imports it.
"""
