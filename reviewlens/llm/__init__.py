"""Operators for preparing training text and searching vectors."""
