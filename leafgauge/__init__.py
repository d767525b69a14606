"""Document analytics on Spark: facts, checks, layout folds and rendering as DataFrame operators."""
