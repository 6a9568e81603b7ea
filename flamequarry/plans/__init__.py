"""flamequarry plans: profiling analytics on Spark."""
