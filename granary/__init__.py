"""Spark-native catalogue consolidation, matching and quality operators.

Every public operator takes DataFrames and returns DataFrames.  Nothing holds a
global session, and nothing collects rows whose number grows with the input.
"""

__version__ = "0.1.0"
