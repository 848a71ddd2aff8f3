"""Learning-event analytics on Spark: DataFrame-in, DataFrame-out operators and the jobs built from them."""
