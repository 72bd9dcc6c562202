"""Structured Streaming forms of the features and of scoring."""
