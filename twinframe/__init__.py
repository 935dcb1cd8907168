"""A Spark-native engine that resolves image pairs between two collections, with operators for training corpora in `llm`."""
