"""Operators wired into whole runs, and the registered queries."""
