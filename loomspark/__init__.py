"""Spark jobs that build language-model training corpora."""
