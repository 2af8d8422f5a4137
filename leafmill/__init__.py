"""leafmill: document analytics and training-data preparation as Spark plans."""
