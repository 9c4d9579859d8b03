"""Operators put together: whole analyses and the registered queries."""
