"""Whole runs, test views, registered queries and their SQL."""
