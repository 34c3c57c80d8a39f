"""Operators for training-data pipelines (see README, "llm")."""
