"""Writers for triples, VoID summaries and small reports."""
