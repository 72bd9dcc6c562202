"""Skyloom: event-time features, point-in-time joins and model training on Spark."""
