"""DataFrame operators: relational steps, splits, features, metrics, ranking, learning."""
