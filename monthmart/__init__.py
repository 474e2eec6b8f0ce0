"""Monthly service-quality data mart on Spark: DataFrame in, DataFrame out."""
