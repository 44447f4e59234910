"""freightflow: a Spark-native warehouse for express-delivery change logs."""
