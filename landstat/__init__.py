"""Land-cover labels, map accuracy and area statistics as Spark DataFrame operators."""
