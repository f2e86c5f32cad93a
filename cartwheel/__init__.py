"""cartwheel: e-commerce sales analytics as Spark DataFrame operators.

Sub-packages:
  sources    -- table scans, adapters to the e-commerce shape, format round trips
  functions  -- column expressions (exact money, ratios, hashed randomness)
  operators  -- sales queries, reports, synthetic data generators, weighted sampling
  plans      -- registered queries with SQL oracles, the end-to-end batch run
"""

__version__ = "0.1.0"
