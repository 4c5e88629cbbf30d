"""creditloom: credit-risk scoring and monitoring as Spark DataFrame plans."""
