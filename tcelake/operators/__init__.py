"""Reusable DataFrame operators; column names are parameters so they work on any table."""
