"""Operators for preparing large text collections for language-model training."""
