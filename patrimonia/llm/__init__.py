"""Training-data operations: one module for each operator, and ``queries`` that registers them."""
