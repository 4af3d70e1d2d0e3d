"""Model specifications, resampling, tuning and scoring."""
