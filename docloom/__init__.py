"""Document preparation on Spark: DataFrame in, DataFrame out."""
