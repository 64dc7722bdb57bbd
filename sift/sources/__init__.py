"""Sources, sinks, schemas and the binding to the generated tables."""
