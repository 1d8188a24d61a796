"""newsquarry: a Spark-native engine for news analytics and text-corpus preparation."""
