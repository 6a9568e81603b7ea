"""flamequarry operators: profiling analytics on Spark."""
