"""A knowledge graph derived from the supplied star-schema tables, for checks and benchmarks."""
