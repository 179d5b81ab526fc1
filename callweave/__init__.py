"""Call-detail analytics on PySpark.

Everything here is a function from DataFrame to DataFrame (or from column to
column). Nothing keeps state between calls and nothing needs a Python UDF:
the plans consist of built-in expressions only, so they stay in the JVM.
"""

from callweave import fixed_values, functions, operators, plans, sources  # noqa: F401

__all__ = ["fixed_values", "functions", "operators", "plans", "sources"]
