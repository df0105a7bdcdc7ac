"""DataFrame -> DataFrame operators: profiling, features, metrics, prefix sums,
lookups, rules, history, images, scoring, models."""
