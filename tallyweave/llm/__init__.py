"""Operators for preparing training data; their queries are listed in ``queries``."""
