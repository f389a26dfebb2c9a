"""Column builders: ids, text folds, vocabularies, dates, names, geometry, similarity."""
