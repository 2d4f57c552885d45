"""Training-data operators: ten distributed text and vector operators and their queries."""
