"""Star-schema builders, the warehouse, its reports and its quality checks."""
