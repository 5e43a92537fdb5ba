"""Clustering, linear scorers and evaluation."""
