"""Compositions over the driver tables, their oracle SQL, and run reports."""
