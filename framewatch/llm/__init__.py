"""Training-data operators on Spark: filtering, de-duplication, indexing,
formatting, mixing and tokenisation of document corpora.

Nothing else in the library imports this subpackage.
"""
