"""Layer plans: bronze, silver, gold, measures."""
