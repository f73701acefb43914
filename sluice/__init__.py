"""Flow analytics on Spark: operators, detection plans and streaming jobs over network-flow tables."""
