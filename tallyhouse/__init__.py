"""Credit-risk feature store, label store, scoring and drift monitoring as Spark DataFrame operators."""
