"""Operators on texts for training corpora.  Nothing outside imports this package."""
