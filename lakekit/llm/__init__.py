"""Training-data operators at corpus scale (one module per operator)."""
