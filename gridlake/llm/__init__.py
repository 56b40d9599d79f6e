"""Training-data operators (quality, dedup, tokens, packing, PII, sharding,
vectors). Nothing else in the library imports this subpackage."""
