"""Operators for training-data pipelines over documents, conversations, pages and embeddings.

Nothing outside this folder imports it.  ``registry`` lists the queries that the
entry module adds when this folder is present.
"""
