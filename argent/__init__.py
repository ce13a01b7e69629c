"""argent: Bronze -> Silver medallion transformations on Spark DataFrames.

Packages:
  functions  column expressions (safe casts, epoch ms, positional access, ...)
  operators  relational operators (keep-one, explode, unions, joins, filters)
  plans      table contracts, the Bronze -> Silver pipelines, the job, queries
  sources    layered table storage, reading by declared schema, Bronze shapes from the test tables
"""

__version__ = "0.1.0"
