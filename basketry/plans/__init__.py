"""The shop's transformations, reports and models."""
