"""Message-log processing on Spark: topics as tables, bundles, records, delivery."""
