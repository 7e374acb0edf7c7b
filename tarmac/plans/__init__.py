"""The composed jobs, built from the operators."""
