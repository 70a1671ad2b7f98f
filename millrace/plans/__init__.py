"""Flows made of the operators: incremental load, publishing, models, maintenance."""
