"""Relational operators of the mart, all plain DataFrame plans."""
