"""Training-data operators (quality, tokens, packing, dedup, chat, PII,
fingerprints, WARC). Nothing else in the library imports this subpackage."""
