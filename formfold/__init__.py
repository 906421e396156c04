"""formfold: Spark-native reporting over nested form submissions and event telemetry."""
