"""Operators for building training corpora from documents, pages and conversations.

Each module holds one operator with a general interface; ``queries.py`` binds
them to the tables of a folder.  Nothing outside this package imports it.
"""
