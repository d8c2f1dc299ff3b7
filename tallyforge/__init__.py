"""Spark-native matchup ranking: pairwise records in, uncertainty-aware ranking out."""
