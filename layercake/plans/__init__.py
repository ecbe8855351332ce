"""Datasets (silver, gold), the pipeline runner, and the driver-table queries."""
