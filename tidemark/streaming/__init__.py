"""Stateful stream operators and the job that runs them."""
