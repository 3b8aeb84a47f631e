"""Labelled-text corpora on Spark: intake, cleaning, splits, annotation, scoring and evaluation."""
