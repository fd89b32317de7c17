"""The jobs of the warehouse, one function each."""
