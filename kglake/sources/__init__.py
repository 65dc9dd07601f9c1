"""Readers that produce triples, catalog, VoID and result tables."""
