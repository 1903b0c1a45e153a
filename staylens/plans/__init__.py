"""The composed jobs: features, fits, scores, saved models and registry records."""
