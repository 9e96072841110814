"""Corpus analytics for long-form documents, written as Spark DataFrame jobs."""
