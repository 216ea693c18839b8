"""loamstack: Spark-native curation of training data, as composable DataFrame transformations."""
