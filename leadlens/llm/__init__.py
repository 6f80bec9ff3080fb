"""Training-data operators: deduplication, quality, licences, tokenization,
packing, archives and language identification over document tables."""
