"""Operators for training data that are tagged llm. Nothing else in the package imports this one."""
