"""Preparation, kNN / ADASYN oversampling, training and evaluation on Spark."""
