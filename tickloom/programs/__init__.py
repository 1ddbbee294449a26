"""Programs for spark-submit: each has ``main(arguments, spark=None)``."""
