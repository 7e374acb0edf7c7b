"""Driving-rewards and flood-risk analytics as Spark table operators."""
