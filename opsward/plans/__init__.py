"""The domain jobs: profiling, cleaning, rules, validation, views, questions and model."""
