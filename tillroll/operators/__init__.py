"""Steps on tables: cleaning raw lines, building the star, checking quality."""
