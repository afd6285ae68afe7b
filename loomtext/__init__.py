"""loomtext: corpus preparation and analysis as Spark DataFrame plans."""
