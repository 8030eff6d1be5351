"""recordloom: record linkage, data quality and corpus preparation as Spark plans."""
