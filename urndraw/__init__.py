"""Draw-results analytics on Spark: parse, store, check, describe and serve repeated number draws."""
