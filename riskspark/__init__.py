"""riskspark: credit-scorecard analytics as Spark DataFrame jobs.

Every public operator takes and returns DataFrames; small fitted artefacts (bin edges,
coefficients, isotonic boundaries) are collected only when their size is bounded by the
number of bins, features or distinct integer scores.
"""

from riskspark.config import ScorecardConfig  # noqa: F401  (re-export)

__all__ = ["ScorecardConfig"]
__version__ = "0.1.0"
