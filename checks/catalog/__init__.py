from checks.catalog import basics, features, learned, modelling, statistics  # noqa: F401
