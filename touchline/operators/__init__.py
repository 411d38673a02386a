"""DataFrame -> DataFrame operators: the derived tables and checks."""
