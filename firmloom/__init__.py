"""firmloom: company records from tables and streams of already-fetched web pages.

Everything is DataFrame in, DataFrame out (``operators``, ``sources``,
``streaming``) or Column in, Column out (``functions``).
"""
