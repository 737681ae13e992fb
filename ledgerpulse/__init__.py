"""Behavioural transaction scoring on Spark: features, scaling, detectors, evaluation, lakehouse."""
