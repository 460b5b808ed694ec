"""Operators for preparing training text: de-duplication, search, token
counts, packing, language-model and toxicity scoring, fill-in-middle texts,
personal data.

Nothing else in the library imports this subpackage. ``catalog`` holds the
registered queries (``op1_...`` to ``op13_...``) and their SQL.
"""
