"""Layered warehouse building blocks on Spark DataFrames.

Every public function takes and returns DataFrames or Columns. Run dates are
arguments, never read from the clock, so a job repeated with the same inputs
gives the same result.
"""
