"""Match-result analytics on Spark: profile, stage, load, model, rank and check."""
