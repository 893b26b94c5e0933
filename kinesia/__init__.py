"""kinesia: wearable-sensor analytics (clean, reduce, bucket, train, score) on PySpark.

Entry points: ``kinesia.plans.preprocess``, ``kinesia.plans.train``,
``kinesia.plans.score_stream`` and the job runners in ``kinesia.plans.jobs``.
"""

__version__ = "0.1.0"
