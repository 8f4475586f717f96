"""Jobs made of operators."""
