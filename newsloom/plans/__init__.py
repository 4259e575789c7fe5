"""Jobs: bronze to silver, gold, warehouse, quality, and the run that chains them."""
