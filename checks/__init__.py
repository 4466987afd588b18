"""Registered queries: each operator over the fixture tables, with its oracle SQL."""
