"""Operators composed into whole runs, plus the registered queries."""
