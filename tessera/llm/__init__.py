"""Operators for preparing training text.

Nothing else in the library imports this subpackage; its queries are listed in
:mod:`tessera.llm.queries`.
"""
