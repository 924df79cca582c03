"""Questions composed of operators, and the report job that answers all of them."""
