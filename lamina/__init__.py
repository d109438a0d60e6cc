"""Document analytics on Spark: layout clean-up, text repair, topics, run comparison."""
