"""Reports and jobs built from the operators."""
