"""Training-data operators: ten components for large text corpora.

Nothing outside this subpackage imports it.  ``queries.py`` holds the thin
``opN_<name>`` queries and their SQL; every other module is one operator.
"""
