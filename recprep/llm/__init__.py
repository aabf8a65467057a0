"""Training-data operators: language, quality, duplicates, tokens, packing,
page text and web archives. Nothing else in the library imports this package;
it may be deleted whole."""
