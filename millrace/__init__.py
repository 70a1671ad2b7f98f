"""millrace: ingestion, modelling and data-quality operators written as Spark DataFrame plans."""
