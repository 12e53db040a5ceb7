"""Tables derived from the star: models, extracts, metrics, page tables, measures."""
