"""The silver and gold models and the batch run that ties them to tables."""
