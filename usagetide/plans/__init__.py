"""The six pipeline models and the lineage that ties them together."""
