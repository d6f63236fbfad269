"""Contest analytics as Spark jobs: cleaning, as-of joins, leakage-safe features, ratings, rollups, models, trials."""
