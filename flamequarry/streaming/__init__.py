"""flamequarry streaming: profiling analytics on Spark."""
