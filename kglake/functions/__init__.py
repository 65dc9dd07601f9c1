"""Column expressions over RDF terms."""
