"""Feature pipeline, estimators, training and scoring on Spark ML."""
