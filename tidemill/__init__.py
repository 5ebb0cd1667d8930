"""Batch analytics of longitudinal wearable studies on Spark, and operators for training data."""
