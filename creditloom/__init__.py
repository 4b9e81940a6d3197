"""creditloom: consumer-credit label, feature, training and monitoring jobs on Spark."""
