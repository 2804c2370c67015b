"""Column-level building blocks: text, stemming, sentiment, entities, JSON."""
