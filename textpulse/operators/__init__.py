"""DataFrame operators: routing, scoring, de-duplication, metrics, evaluation, models."""
