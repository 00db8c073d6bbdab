"""Training-data operators: dedup, filters, packing, scoring. Nothing else in the library imports this package."""
