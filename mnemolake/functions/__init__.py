"""Column functions: scalars, text analysis, stemming, vectors, embedders."""
