"""Document analytics on Spark: parsing, chunking, validation, indexing plans, exact search and evaluation."""
