"""Registered queries: one per operator, each with its oracle where SQL can state it."""
