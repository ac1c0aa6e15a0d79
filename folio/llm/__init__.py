"""Operators for preparing training text.

Nothing else in the library imports this subpackage.  Each module holds one
operator (or one part shared by several); :mod:`folio.llm.registry` holds the
registered queries and their SQL.
"""
