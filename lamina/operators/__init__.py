"""DataFrame operators: layout clean-up, order, quality, rules, topics, comparison, search."""
