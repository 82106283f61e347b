"""Training-data operators: filters, deduplication, classifiers, packing, token files and search."""
