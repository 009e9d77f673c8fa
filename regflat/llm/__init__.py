"""Operators for preparing large text corpora; one module each, queries in ``queries``."""
