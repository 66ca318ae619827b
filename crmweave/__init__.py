"""CRM synchronisation on Spark: every operator is DataFrame in, DataFrame out."""
