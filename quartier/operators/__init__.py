"""Transformations from inputs to the star schema, and the building blocks of the reports."""
