"""Operators for preparing training corpora, each a Spark job over documents or pages."""
