"""Operators that prepare training data for language models.

Nothing outside this folder imports it; the queries it offers are collected in
``colsink.llm.queries``.
"""
