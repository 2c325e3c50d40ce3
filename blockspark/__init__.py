"""blockspark: documents to retrieval-ready data, as Spark plans."""
