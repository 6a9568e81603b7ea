"""flamequarry sources: profiling analytics on Spark."""
