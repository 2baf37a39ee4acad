"""Operators on training text: one module per operator, ``queries`` registers them. Nothing outside imports this package."""
