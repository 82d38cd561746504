"""Sources: topic-shaped records (fixture, file replay, Kafka), files, lake."""
