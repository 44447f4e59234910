"""Operators for preparing training corpora, one module each. Nothing else imports this package."""
