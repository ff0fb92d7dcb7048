"""Operators for preparing training text: ten corpus operators, their queries and their SQL checks."""
