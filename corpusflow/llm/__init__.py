"""Operators for preparing large training corpora, with their queries."""
