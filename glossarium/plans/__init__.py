"""Named queries and the pipelines built from the operators."""
