"""Plans: the model DAG, serving queries and the query registry."""
