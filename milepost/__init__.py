"""Customer-experience and last-mile fulfilment analytics on Spark DataFrames.

Every operator takes and returns DataFrames (or Columns), is lazy, and takes an
explicit ``as_of`` wherever a rule depends on the current time.
"""

__version__ = "0.1.0"
