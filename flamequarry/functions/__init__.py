"""flamequarry functions: profiling analytics on Spark."""
