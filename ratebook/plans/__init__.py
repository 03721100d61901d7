"""Plans: end-to-end pipelines and the bindings of operators to tables."""
