"""DataFrame -> DataFrame operators of the churn pipeline."""
