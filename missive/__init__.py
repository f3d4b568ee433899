"""Labelled-message analytics on Spark: cleaning, features, models, thresholds and evaluation as DataFrame operators."""
