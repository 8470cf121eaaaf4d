"""Item-to-item recommendation, its feature engineering and its offline evaluation, as Spark DataFrame jobs."""
