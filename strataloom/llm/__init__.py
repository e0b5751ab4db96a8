"""Operators that prepare training text, and their registered queries. Nothing else imports this package."""
