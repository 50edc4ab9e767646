"""DataFrame -> DataFrame operators: pairing, trips, snapshots, state, features, evaluation, models."""
