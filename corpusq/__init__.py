"""Corpus preparation, retrieval, batch inference and chat history as Spark DataFrame operators."""
