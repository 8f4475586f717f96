"""varve: layered (bronze, silver, gold) sensor and market tables as Spark DataFrame operators."""
