"""Reports and the load job, composed from the operators."""
