"""Facility analytics as Spark DataFrame operators.

Every operator takes DataFrames and column names and returns a DataFrame; the
plans in ``millrace.plans`` compose them into file-to-silver, silver-to-gold
and report runs.
"""

__version__ = "0.1.0"
