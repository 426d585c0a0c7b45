"""DataFrame-to-DataFrame operators without hidden session state."""
