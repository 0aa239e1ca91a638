"""Operators for preparing training text: extraction, tokens, language, quality, copies, leaks, personal data."""
