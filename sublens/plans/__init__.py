"""Feature pipelines: plain functions from tables and a load date to a DataFrame."""
