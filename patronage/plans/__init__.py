"""Named reports, experiments and the catalogue of queries."""
