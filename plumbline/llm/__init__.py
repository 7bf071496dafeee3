"""Operators for training-data corpora: mixing, secrets, tokens, archives, filters, copies, search, licences.

Nothing else in the package imports this one.  Each operator is a module with its own interface;
``queries`` applies all of them to whole tables.
"""
