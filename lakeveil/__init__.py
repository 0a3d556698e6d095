"""Governance of lakehouse tables that hold personal data, expressed on Spark.

Every operator takes and returns DataFrames or Columns; Catalyst plans the
work. See README.md for the map of the package.
"""
