"""DataFrame-to-DataFrame operators: cleaning, features, quality, star schema, analytics."""
