"""Operators of a training-data pipeline over documents, embeddings and
conversations. Each module holds one operator with its general interface;
``queries`` registers the thin query of each. Nothing outside this
subpackage imports it."""
