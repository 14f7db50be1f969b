"""Entry point for spark-submit; see ``incidentry/plans/runner.py``."""

from pyspark.sql import SparkSession

from incidentry.plans.runner import run

if __name__ == "__main__":
    run(SparkSession.builder.appName("incident-reports").getOrCreate())
