"""Operators for preparing language-model training data.

Nothing outside this folder imports it.  Each module has a general operator and
the thin ``opN_...`` query over the shared tables; ``registry`` lists the latter.
"""
