"""Season-long fantasy league analytics as Spark DataFrame plans."""
