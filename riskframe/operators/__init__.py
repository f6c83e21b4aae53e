"""DataFrame operators: features, splits, profiles, models and metrics."""
