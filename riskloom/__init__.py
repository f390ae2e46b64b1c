"""riskloom: transaction-risk analytics as Spark DataFrame operators."""
