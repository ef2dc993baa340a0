"""The datasets, layer by layer: bronze, silver, gold, audits, and the fraud features and model."""
